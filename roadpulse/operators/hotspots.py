"""Risk hotspots on a rounded grid, and events near points."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.risk import effective_risk_replay
from .serving import Sources, default_bounds, mode_sources, project, time_range, union_all

REPLAY_LOOKBACK_S = 7 * 86400
LIVE_LOOKBACK_S = 24 * 3600
CELL_DIGITS = 3
_HOURS = 64


def _score_order() -> list[Column]:
    """Highest average first. Averages are compared to ten places: beyond that, summation order rules."""
    return [F.round("avg_risk_score", 10).desc(), F.col("accident_count").desc()]


def hotspots(df: DataFrame, min_events: int = 5) -> DataFrame:
    """Grid cells of a projected table with enough events: average risk, counts, most frequent hour.

    Rows are first counted by cell and hour, so the second step sees at most 25 rows per cell and a
    cell with very many events is merged map-side. The most frequent hour (the earliest on a tie) is
    the maximum of one integer that holds count and hour. Rows without risk are left out by counting
    the risk, not by a filter on it: a filter would be moved below the scoring and score twice.
    """
    rows = df.where("lat is not null and lon is not null").select(
        geo.cell(F.col("lat"), CELL_DIGITS).alias("center_lat"),
        geo.cell(F.col("lon"), CELL_DIGITS).alias("center_lon"),
        "risk_score", "is_severe", "hour",
    )
    hourly = rows.groupBy("center_lat", "center_lon", "hour").agg(
        F.sum("risk_score").alias("risk"), F.count("risk_score").alias("n"),
        F.count(F.when(F.col("is_severe"), F.col("risk_score"))).alias("severe"),
    )
    ranked_hour = F.when(F.col("hour").isNotNull() & (F.col("n") > 0), F.col("n") * _HOURS + (_HOURS - 1 - F.col("hour")))
    cells = hourly.groupBy("center_lat", "center_lon").agg(
        F.sum("risk").alias("risk"), F.sum("n").alias("accident_count"), F.sum("severe").alias("severe_count"),
        F.max(ranked_hour).alias("best"),
    )
    return cells.where(F.col("accident_count") >= max(1, min_events)).select(
        "center_lat", "center_lon", (F.col("risk") / F.col("accident_count")).alias("avg_risk_score"),
        "accident_count", "severe_count",
        (F.lit(_HOURS - 1) - F.pmod(F.col("best"), F.lit(_HOURS))).cast("int").alias("peak_hour"),
    )


def ranked(df: DataFrame, ties: list[str], limit: int) -> DataFrame:
    """The first ``limit`` cells with their rank. The window runs after the cut, over few rows."""
    order = [*_score_order(), *[F.col(c) for c in ties]]
    top = df.orderBy(*order).limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_hotspots(
    sources: Sources, limit: int = 20, min_events: int = 5, start=None, end=None, mode: str | None = None
) -> DataFrame:
    """Riskiest cells of a mode's tables, ranked from 1.

    Without bounds each table is read back from its latest event: 7 days of replay, 24 hours of live.
    Equal cells of two tables stay two rows.
    """
    chosen = mode_sources(sources, mode)
    cut = limit if len(chosen) == 1 else max(limit, math.ceil(limit / max(1, len(chosen))) * 3)
    lookback = {"replay": REPLAY_LOOKBACK_S, "live": LIVE_LOOKBACK_S}
    labels = {"replay": sources.replay_label, "live": sources.live_label}
    frames = []
    for kind, df in chosen.items():
        df = time_range(df, start, end) if start or end else default_bounds(df, lookback[kind])
        cells = hotspots(project(df, kind, labels[kind]), min_events)
        best = cells.orderBy(*_score_order(), "center_lat", "center_lon").limit(cut)
        frames.append(best.withColumn("data_source", F.lit(labels[kind])))
    return ranked(union_all(frames), ["data_source", "center_lat", "center_lon"], limit)


def hotspot_detail(sources: Sources, rank: int) -> DataFrame:
    """One cell of the default ranking by its rank; empty when there is none."""
    return top_hotspots(sources, limit=max(1, rank)).where(F.col("rank") == rank)


def _distance(method: str):
    return geo.haversine_m if method == "haversine" else geo.flat_distance_m


def nearby(
    replay: DataFrame, lat: float, lon: float, radius_m: float = 5000.0, limit: int = 100,
    method: str = "haversine",
) -> DataFrame:
    """Events inside a radius of one point, nearest first. The box reaches the file scan."""
    cos = math.cos(math.radians(lat))
    height = radius_m / geo.METERS_PER_DEGREE
    width = radius_m / max(1.0, geo.METERS_PER_DEGREE * cos)
    distance = _distance(method)(F.col("lat"), F.col("lon"), F.lit(lat), F.lit(lon))
    # The great-circle circle reaches slightly past the flat box, so its box has a margin.
    margin = 1.01 if method == "haversine" else 1.0
    boxed = replay.where(
        F.col("lat").between(lat - height * margin, lat + height * margin)
        & F.col("lon").between(lon - width * margin, lon + width * margin)
    )
    hits = boxed.select(
        "event_id", "lat", "lon", effective_risk_replay().alias("risk_score"), distance.alias("distance_m")
    ).where(F.col("distance_m") <= radius_m)
    return hits.orderBy("distance_m", "event_id").limit(limit)


def _grid(radius_m: float):
    """Row and column of a position on a grid whose cells are at least one radius high and wide.

    Rows are equal in latitude. A row's columns are as wide as a circle reaches in longitude at the
    edge of the next row towards the pole; where it reaches the pole the row is one cell.
    """
    height = radius_m / geo.METERS_PER_DEGREE * 1.01
    row = lambda lat: F.floor((lat + 90.0) / height).cast("bigint")

    def width(r: Column) -> Column:
        low, high = (r - 1) * height - 90.0, (r + 2) * height - 90.0
        edge = F.least(F.lit(90.0), F.greatest(F.abs(low), F.abs(high)))
        ratio = F.lit(math.sin(math.radians(min(180.0, height)) / 2)) / F.cos(F.radians(edge))
        return F.when((ratio > 0) & (ratio < 1), F.degrees(2 * F.asin(ratio)) * 1.001).otherwise(F.lit(360.0))

    column = lambda lon, r: F.floor((lon + 180.0) / width(r)).cast("bigint")
    return height, width, row, column


def _covering_cells(centers: DataFrame, radius_m: float) -> DataFrame:
    """One row per grid cell that a center's circle may touch, across the date line as well."""
    height, width, row, column = _grid(radius_m)
    lat, lon = F.col("center_lat"), F.col("center_lon")
    rows = F.sequence(row(F.greatest(F.lit(-90.0), lat - height)), row(F.least(F.lit(90.0), lat + height)))
    asked = centers.select("*", F.explode(rows).alias("_row"))
    reach = width(F.col("_row"))

    def columns(shift: float) -> Column:
        west = F.greatest(F.lit(-180.0), lon + shift - reach)
        east = F.least(F.lit(180.0), lon + shift + reach)
        found = F.sequence(column(west, F.col("_row")), column(east, F.col("_row")))
        return F.when(west <= east, found).otherwise(F.array().cast("array<bigint>"))

    every = F.array_distinct(F.concat(columns(-360.0), columns(0.0), columns(360.0)))
    return asked.select("*", F.explode(every).alias("_col"))


def reach(events: DataFrame, centers: DataFrame, radius_m: float) -> DataFrame:
    """Pairs of distinct places, one of events and one of centers, within a radius, with their distance.

    Events fall into one grid cell; a center place asks for the cells its circle touches, so the join is an
    equality on the cell followed by the distance test. However many events or centers share a place, it
    takes part once; ``n_events`` and ``n_centers`` say how many. ``centers`` has center_lat, center_lon.
    """
    _, _, row, column = _grid(radius_m)
    spots = events.where("lat is not null and lon is not null").groupBy("lat", "lon").agg(F.count("*").alias("n_events"))
    spots = spots.withColumn("_row", row(F.col("lat"))).withColumn("_col", column(F.col("lon"), F.col("_row")))
    asked = centers.groupBy("center_lat", "center_lon").agg(F.count("*").alias("n_centers"))
    distance = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("center_lat"), F.col("center_lon"))
    pairs = spots.join(_covering_cells(asked, radius_m), ["_row", "_col"]).withColumn("distance_m", distance)
    return pairs.where(F.col("distance_m") <= radius_m).drop("_row", "_col")


def nearby_join(events: DataFrame, centers: DataFrame, radius_m: float) -> DataFrame:
    """All (center, event) pairs inside a radius, with their distance: for callers that need every pair.

    ``nearby_totals`` and ``nearest_per_center`` never build them. ``centers`` has center_id, center_lat,
    center_lon.
    """
    near = reach(events, centers, radius_m).drop("n_events", "n_centers")
    return near.join(events, ["lat", "lon"]).join(centers, ["center_lat", "center_lon"]).select(
        *events.columns, *centers.columns, "distance_m")


def nearby_totals(events: DataFrame, centers: DataFrame, radius_m: float) -> DataFrame:
    """Events inside a radius of each center and the sum of their distances; centers without any are left out."""
    sums = reach(events, centers, radius_m).groupBy("center_lat", "center_lon").agg(
        F.sum("n_events").alias("n"), F.sum(F.col("n_events") * F.col("distance_m")).alias("total_distance"))
    return centers.join(sums, ["center_lat", "center_lon"]).select("center_id", "n", "total_distance")


def centers_around(events: DataFrame, centers: DataFrame, radius_m: float) -> DataFrame:
    """Centers inside a radius of each event; events without any are left out."""
    sums = reach(events, centers, radius_m).groupBy("lat", "lon").agg(F.sum("n_centers").alias("n"))
    return events.join(sums, ["lat", "lon"]).select("event_id", "n")


def nearest_per_center(events: DataFrame, centers: DataFrame, radius_m: float, limit: int) -> DataFrame:
    """The nearest events of each center inside a radius: center_id, event_id, distance_m, rank.

    Only the first ``limit`` events of a place can be among them; ranks are cut before each shuffle.
    """
    first = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("event_id"))
    kept = events.select("event_id", "lat", "lon").withColumn("_n", first).where(F.col("_n") <= limit).drop("_n")
    order = Window.partitionBy("center_lat", "center_lon").orderBy("distance_m", "event_id")
    best = reach(events, centers, radius_m).join(kept, ["lat", "lon"]).withColumn("rank", F.row_number().over(order))
    best = best.where(F.col("rank") <= limit).select("center_lat", "center_lon", "event_id", "distance_m", "rank")
    return centers.join(best, ["center_lat", "center_lon"]).select("center_id", "event_id", "distance_m", "rank")


def extent(df: DataFrame) -> DataFrame:
    """Bounds, centre and spans of a point set; spans are at least 8 by 6 degrees."""
    box = df.where("lat is not null and lon is not null").agg(
        F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
        F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
    )
    return box.select(
        "*",
        ((F.col("min_lon") + F.col("max_lon")) / 2).alias("center_lon"),
        ((F.col("min_lat") + F.col("max_lat")) / 2).alias("center_lat"),
        F.greatest(F.lit(8.0), F.col("max_lon") - F.col("min_lon")).alias("lon_span"),
        F.greatest(F.lit(6.0), F.col("max_lat") - F.col("min_lat")).alias("lat_span"),
    )
