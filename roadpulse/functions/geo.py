"""Geometry of incident payloads, distances and grid cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius, and metres per degree of the flat approximation.
EARTH_RADIUS_M = 6_371_008.8
METERS_PER_DEGREE = 111_320.0


def first_coordinate(coordinates: Column) -> Column:
    """struct(lat, lon) of the first position in GeoJSON coordinates of any depth (JSON text).

    The first position is what follows the opening brackets. Null unless it has two numbers.
    """
    position = F.split(F.regexp_extract(coordinates, r"^[\s\[]*([^\[\]]*)\]", 1), ",")
    number = lambda i: F.get(position, i).try_cast("double")
    both = number(0).isNotNull() & number(1).isNotNull()
    return F.struct(F.when(both, number(1)).alias("lat"), F.when(both, number(0)).alias("lon"))


def to_wkt(coordinates: Column, kind: Column) -> Column:
    """WKT of a point or line given as JSON text; any other geometry gives blank text.

    Numbers keep their spelling, since they are read as text.
    """
    point = F.from_json(coordinates, "array<string>")
    line = F.from_json(coordinates, "array<array<string>>")
    usable = F.filter(line, lambda p: F.size(p) >= 2)
    text = F.array_join(F.transform(usable, lambda p: F.concat(p[0], F.lit(" "), p[1])), ", ")
    name = F.lower(F.coalesce(kind, F.lit("")))
    wkt = (
        F.when(
            (name == "point") & (F.size(point) >= 2),
            F.concat(F.lit("POINT ("), F.get(point, 0), F.lit(" "), F.get(point, 1), F.lit(")")),
        )
        .when((name == "linestring") & (F.size(usable) > 0), F.concat(F.lit("LINESTRING ("), text, F.lit(")")))
    )
    return F.coalesce(wkt, F.lit(""))


def haversine_m(lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.sin(F.radians(lat - lat0) / 2)
    half_lon = F.sin(F.radians(lon - lon0) / 2)
    inner = half_lat * half_lat + F.cos(F.radians(lat0)) * F.cos(F.radians(lat)) * half_lon * half_lon
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(inner)))


def flat_distance_m(lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    """Distance in metres on a plane tangent at the centre; good for short radii."""
    dlat = lat - lat0
    dlon = (lon - lon0) * F.cos(F.radians(lat0))
    return METERS_PER_DEGREE * F.sqrt(dlat * dlat + dlon * dlon)


def cell(value: Column, digits: int = 3) -> Column:
    """Rounded coordinate that names a grid cell."""
    return F.round(value, digits)
