"""Grouped metrics over the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.risk import HIGH_RISK, effective_risk_replay
from .serving import Sources, common_view, mode_sources, normalize_mode, projected, time_range, union_all

GROUPS = ("day", "month", "year")
METRICS = ("avg_risk", "count", "high_risk_count")
# Metric -> (feature column, top of the range); eight equal buckets from 0.
HISTOGRAMS = {
    "temperature": ("temperature_f", 130), "humidity": ("humidity", 100), "wind_speed": ("wind_speed_mph", 100),
}
BINS = 8


def _high(risk: Column) -> Column:
    return F.count_if(risk >= HIGH_RISK)


def _with_risk(grouped, risk: str, *more: Column) -> DataFrame:
    """Average risk and events of each group, counting rows that have a risk.

    Counting replaces a filter on the computed risk, which the optimizer would evaluate twice.
    """
    out = grouped.agg(F.avg(risk).alias("avg_risk_score"), F.count(risk).alias("accident_count"), *more)
    return out.where(F.col("accident_count") > 0)


def timeseries(
    replay: DataFrame, group_by: str = "day", metric: str = "avg_risk", start=None, end=None
) -> DataFrame:
    """Average risk, events and high-risk events by day, month or year of the replay table.

    ``value`` is the chosen metric as a double. Unknown groups mean day, unknown metrics avg_risk.
    """
    part = group_by if group_by in GROUPS else "day"
    chosen = metric if metric in METRICS else "avg_risk"
    day = F.to_date("event_time")
    rows = time_range(replay, start, end).select(
        (day if part == "day" else F.trunc(day, part)).alias("time"), effective_risk_replay().alias("risk")
    )
    out = _with_risk(
        rows.where("time is not null").groupBy("time"), "risk", _high(F.col("risk")).alias("high_risk_count")
    )
    value = {"avg_risk": "avg_risk_score", "count": "accident_count", "high_risk_count": "high_risk_count"}
    return out.withColumn("value", F.col(value[chosen]).cast("double"))


def severity_distribution(sources: Sources, mode: str | None = None) -> DataFrame:
    """Events by ground-truth severity."""
    rows = common_view(sources, mode).select(F.col("true_severity").alias("severity"))
    return rows.where("severity is not null").groupBy("severity").agg(F.count("*").alias("count"))


def risk_by_hour(sources: Sources, mode: str | None = None) -> DataFrame:
    """Average risk and events by hour of day."""
    rows = common_view(sources, mode).where("hour is not null")
    return _with_risk(rows.groupBy("hour"), "risk_score")


def risk_by_weather(replay: DataFrame) -> DataFrame:
    """Average risk and events by weather code of the replay table; a null code is a group."""
    rows = replay.select("weather_code", effective_risk_replay().alias("risk"))
    return _with_risk(rows.groupBy("weather_code"), "risk")


def weather_histogram(sources: Sources, mode: str | None = None) -> DataFrame:
    """Bucket counts of temperature, humidity and wind in one pass over the tables.

    Bucket 0 lies below 0 and bucket 9 at or above the top. The label is the observed minimum and
    maximum of the bucket over all sources.
    """
    columns = [c for c, _ in HISTOGRAMS.values()]
    frames = [df.select(*columns) for df in mode_sources(sources, mode).values()]
    arms = ", ".join(f"'{name}', {column}, {top}" for name, (column, top) in HISTOGRAMS.items())
    long = union_all(frames).select(F.expr(f"stack({len(HISTOGRAMS)}, {arms}) as (metric, value, top)"))
    bucket = F.width_bucket(F.col("value"), F.lit(0.0), F.col("top").cast("double"), F.lit(BINS))
    out = (
        long.where("value is not null").groupBy("metric", bucket.cast("int").alias("bin_idx"))
        .agg(F.min("value").alias("bin_min"), F.max("value").alias("bin_max"), F.count("*").alias("count"))
    )
    label = F.concat(F.format_number("bin_min", 0), F.lit("-"), F.format_number("bin_max", 0))
    return out.withColumn("bin", label)


def overview(sources: Sources, mode: str | None = None) -> DataFrame:
    """Totals over a mode's tables, exact: events, high-risk events, average risk, latest time.

    Each table's average is weighted by all of its rows.
    """
    parts = [
        df.agg(
            F.count("*").alias("total_events"),
            _high(F.col("risk_score")).alias("high_risk_events"),
            F.coalesce(F.avg("risk_score"), F.lit(0.0)).alias("avg_risk"),
            F.max("event_time").alias("latest_event_time"),
        )
        for df in projected(sources, mode)
    ]
    return _combined(parts, mode)


def _combined(parts: list[DataFrame], mode: str | None) -> DataFrame:
    total = F.sum("total_events")
    weighted = F.sum(F.col("avg_risk") * F.col("total_events"))
    average = F.when(total > 0, F.round(weighted / total, 4)).otherwise(F.lit(0.0))
    return union_all(parts).agg(
        F.coalesce(total, F.lit(0)).alias("total_events"),
        F.coalesce(F.sum("high_risk_events"), F.lit(0)).alias("high_risk_events"),
        average.alias("avg_risk_score"),
        F.max("latest_event_time").alias("latest_event_time"),
    ).withColumn("mode", F.lit(normalize_mode(mode)))
