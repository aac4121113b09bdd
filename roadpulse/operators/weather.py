"""Nearest-hour weather for events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import hour_floor, to_utc

VALUES = ["weather_code", "temperature_f", "humidity", "wind_speed_mph"]
CELL_DIGITS = 2


def explode_hourly(df: DataFrame, payload: str = "hourly") -> DataFrame:
    """Landed hourly responses (parallel arrays, one row per cell) to one row per cell and slot."""
    zipped = F.arrays_zip(
        F.col(f"{payload}.time").alias("slot_text"),
        F.col(f"{payload}.weather_code").alias("weather_code"),
        F.col(f"{payload}.temperature_2m").alias("temperature_f"),
        F.col(f"{payload}.relative_humidity_2m").alias("humidity"),
        F.col(f"{payload}.wind_speed_10m").alias("wind_speed_mph"),
    )
    rows = df.withColumn("_h", F.explode(zipped))
    slot = to_utc(F.col("_h.slot_text"))
    return rows.select(
        "cell_lat", "cell_lon", F.to_date(slot).alias("obs_date"), slot.alias("slot"),
        *[F.col(f"_h.{v}").alias(v) for v in VALUES],
    ).where("slot is not null")


def hourly_lookup(weather: DataFrame) -> DataFrame:
    """For every cell and day of the weather table, its slots that can be nearest to a full hour, as one array.

    Those are the first and the last slot of each clock hour: 48 entries a day at most, however many slots
    a cell has. Equal slots keep the lesser values.
    """
    place = ["cell_lat", "cell_lon", "obs_date"]
    slots = weather.where("slot is not null").groupBy(*place, "slot").agg(F.min(F.struct(*VALUES)).alias("v"))
    ends = slots.groupBy(*place, F.date_trunc("hour", "slot").alias("_hour")).agg(
        F.min_by(F.struct("slot", "v"), "slot").alias("first"), F.max_by(F.struct("slot", "v"), "slot").alias("last"))
    return ends.groupBy(*place).agg(F.array_distinct(F.flatten(F.collect_list(F.array("first", "last")))).alias("slots"))


def join_weather(events: DataFrame, weather: DataFrame, lat: str, lon: str, utc_time: str) -> DataFrame:
    """Events with the nearest slot of their cell and day, as columns ``wx_slot``, ``wx_...``; the earlier on a tie.

    A left join on three equal columns, then a pick in a short array. Whether the lookup is broadcast is
    left to its measured size; otherwise adaptive execution splits a cell and day that holds many events.
    """
    lookup = hourly_lookup(weather)
    hour = hour_floor(F.col(utc_time))
    keyed = events.select(
        "*",
        F.round(F.col(lat), CELL_DIGITS).alias("cell_lat"),
        F.round(F.col(lon), CELL_DIGITS).alias("cell_lon"),
        F.to_date(hour).alias("obs_date"),
        hour.alias("_asked"),
    )
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    away = F.transform("slots", lambda s: F.struct(
        F.abs(micros(s["slot"]) - micros(F.col("_asked"))).alias("away"), s["slot"].alias("slot"), s["v"].alias("v")))
    joined = keyed.join(lookup, ["cell_lat", "cell_lon", "obs_date"], "left").withColumn("_wx", F.array_min(away))
    return joined.select(
        *[F.col(c) for c in events.columns], F.col("_wx.slot").alias("wx_slot"),
        *[F.col(f"_wx.v.{v}").alias(f"wx_{v}") for v in VALUES],
    )


def lookup_work_list(events: DataFrame, lat: str, lon: str, utc_time: str) -> DataFrame:
    """Distinct cells and hours that still need weather: what a loader has to fetch, once each."""
    hour = hour_floor(F.col(utc_time))
    return events.select(
        F.round(F.col(lat), CELL_DIGITS).alias("cell_lat"),
        F.round(F.col(lon), CELL_DIGITS).alias("cell_lon"),
        hour.alias("slot"),
    ).distinct()
