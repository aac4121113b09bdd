"""How fresh and how fast the serving tables are."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import parse_window
from .quantiles import exact_percentiles
from .serving import union_all

# Longest credible latency, and column preferences.
LATENCY_LIMIT_MS = 3_600_000.0
TIME_COLUMNS = ("processed_time", "updated_at", "created_at", "ingestion_time", "event_time")
LATENCY_COLUMNS = ("processing_latency_ms", "inference_latency_ms", "end_to_end_latency_ms")
PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def time_column(columns) -> str | None:
    """The preferred time column of a table, or None."""
    return next((c for c in TIME_COLUMNS if c in set(columns)), None)


def _now(now) -> Column:
    return (F.lit(now) if now is not None else F.localtimestamp()).cast("timestamp_ntz")


def _seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n).cast("decimal(18,6)"))


def _times(tables: dict[str, DataFrame], *extra) -> list[DataFrame]:
    """(table, t, extra...) of every table that has a usable time column."""
    frames = []
    for name, df in tables.items():
        column = time_column(df.columns)
        if column:
            frames.append(df.select(F.lit(name).alias("table"), F.col(column).alias("t"), *[e(df) for e in extra]))
    return frames


def _anchor(rows: DataFrame, seconds: int, now) -> DataFrame:
    """One row: the end of the window, and whether that end is the present.

    A stream whose latest row is older than the window is measured back from that row instead.
    """
    latest = F.max("t")
    live = latest.isNull() | (latest >= _now(now) - _seconds(seconds))
    return rows.agg(
        F.when(live, _now(now)).otherwise(latest).alias("window_anchor"), live.alias("is_live_window")
    )


def _in_window(rows: DataFrame, anchor: DataFrame, seconds: int) -> Column:
    end = anchor.select("window_anchor").scalar()
    return F.col("t").between(end - _seconds(seconds), end)


def _status(count: Column, live: Column) -> Column:
    return (
        F.when((count > 0) & live, F.lit("ok")).when(count > 0, F.lit("stale"))
        .otherwise(F.lit("not_enough_data"))
    )


def _unavailable(spark, window: str, schema: str) -> DataFrame:
    return spark.createDataFrame([("unavailable", window)], schema)


def throughput(tables: dict[str, DataFrame], window: str = "5m", now: datetime | str | None = None) -> DataFrame:
    """Rows in a lookback window over all tables, and their rate.

    ``now`` makes the result repeatable. The time filter is a scalar subquery over column statistics
    of one column, so both passes read that column only.
    """
    frames = _times(tables)
    if not frames:
        spark = next(iter(tables.values())).sparkSession
        return _unavailable(spark, window, "status string, window string")
    seconds = parse_window(window)
    rows = union_all(frames)
    anchor = _anchor(rows, seconds, now)
    counted = rows.where(_in_window(rows, anchor, seconds)).agg(F.count("*").alias("event_count"))
    n = F.col("event_count")
    live = anchor.select("is_live_window").scalar()
    return counted.select(
        _status(n, live).alias("status"), F.lit(window).alias("window"), F.lit(seconds).alias("window_seconds"),
        anchor.select("window_anchor").scalar().alias("window_anchor"), live.alias("is_live_window"), n,
        F.round(n / F.lit(seconds / 60.0), 4).alias("events_per_minute"),
        F.round(n / F.lit(float(seconds)), 4).alias("events_per_second"),
    )


def throughput_by_table(tables: dict[str, DataFrame], window: str = "5m", now=None) -> DataFrame:
    """Rows of each table in the common lookback window, with its own status and latest time."""
    seconds = parse_window(window)
    rows = union_all(_times(tables))
    anchor = _anchor(rows, seconds, now)
    inside = _in_window(rows, anchor, seconds)
    out = rows.groupBy("table").agg(F.count_if(inside).alias("event_count"), F.max("t").alias("latest_timestamp"))
    return out.withColumn("status", _status(F.col("event_count"), anchor.select("is_live_window").scalar()))


def latency_column(columns) -> str | None:
    """The first latency column a table has, or None."""
    return next((c for c in LATENCY_COLUMNS if c in set(columns)), None)


def _samples(tables: dict[str, DataFrame], column: str | None, seconds: int, now):
    """Credible latencies inside the window, with the anchor; None when no table qualifies."""
    chosen = {n: column or latency_column(df.columns) for n, df in tables.items()}
    usable = {n: df for n, df in tables.items() if chosen[n] in df.columns and time_column(df.columns)}
    if not usable:
        return None
    frames = [
        df.select(F.lit(n).alias("table"), F.col(time_column(df.columns)).alias("t"), F.col(chosen[n]).alias("latency_ms"))
        for n, df in usable.items()
    ]
    rows = union_all(frames)
    anchor = _anchor(rows, seconds, now)
    inside = _in_window(rows, anchor, seconds) & F.col("latency_ms").between(0.0, LATENCY_LIMIT_MS)
    return rows.where(inside), anchor


def latency(
    tables: dict[str, DataFrame], metric: str = "p95", window: str = "5m", now=None, column: str | None = None
) -> DataFrame:
    """Latency percentiles and average over a recent window; ``value_ms`` is the chosen metric.

    By default each table gives the first latency column it has, which mixes inference latency with
    end-to-end latency; ``column`` names one for all tables.
    """
    seconds = parse_window(window)
    found = _samples(tables, column, seconds, now)
    if found is None:
        spark = next(iter(tables.values())).sparkSession
        return _unavailable(spark, window, "status string, window string")
    rows, anchor = found
    totals = rows.agg(F.avg("latency_ms").alias("avg"), F.count("latency_ms").alias("sample_count"))
    quantiles = exact_percentiles(rows, "latency_ms", PERCENTILES)
    chosen = metric if metric in (*PERCENTILES, "avg") else "p95"
    live = anchor.select("is_live_window").scalar()
    joined = totals.withColumn("_q", quantiles.select(F.struct(*PERCENTILES)).scalar()).select("*", "_q.*")
    return joined.select(
        _status(F.col("sample_count"), live).alias("status"), F.lit(chosen).alias("metric"),
        F.lit(window).alias("window"), anchor.select("window_anchor").scalar().alias("window_anchor"),
        live.alias("is_live_window"), F.col(chosen).alias("value_ms"), *PERCENTILES, "avg", "sample_count",
    )


def latency_by_table(tables: dict[str, DataFrame], window: str = "5m", now=None, column: str | None = None) -> DataFrame:
    """The same percentiles for each table on its own."""
    rows, _ = _samples(tables, column, parse_window(window), now)
    totals = rows.groupBy("table").agg(F.avg("latency_ms").alias("avg"), F.count("latency_ms").alias("sample_count"))
    return totals.join(exact_percentiles(rows, "latency_ms", PERCENTILES, by=["table"]), "table")


def replay_health(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, latest event and status of each table, by exact counts."""
    frames = [
        df.agg(F.count("*").alias("row_count"), F.max("event_time").alias("latest_event_time"))
        .withColumn("table", F.lit(name))
        for name, df in tables.items()
    ]
    status = F.when(F.col("row_count") > 0, F.lit("ok")).otherwise(F.lit("not_enough_data"))
    return union_all(frames).withColumn("status", status)


def table_report(df: DataFrame, column: str = "end_to_end_latency_ms") -> DataFrame:
    """Rows, first and last event time, average and 95th percentile latency, to two places."""
    totals = df.agg(
        F.count("*").alias("rows"), F.min("event_time").alias("min_event_time"),
        F.max("event_time").alias("max_event_time"), F.round(F.avg(column), 2).alias("avg_latency_ms"),
    )
    p95 = exact_percentiles(df, column, {"p95": 0.95}).scalar()
    return totals.withColumn("p95_latency_ms", F.round(p95, 2))


def run_report(df: DataFrame, elapsed_seconds: float, column: str = "end_to_end_latency_ms") -> DataFrame:
    """Rows, throughput, mean and 95th percentile latency of one run, to four places."""
    elapsed = max(elapsed_seconds, 1e-6)
    p95 = exact_percentiles(df, column, {"p95": 0.95}).scalar()
    return df.agg(
        F.count("*").alias("rows"), F.lit(round(elapsed, 4)).alias("elapsed_seconds"),
        F.round(F.count("*") / F.lit(elapsed), 4).alias("throughput_tps"),
        F.round(F.avg(column), 4).alias("latency_ms_avg"),
    ).withColumn("latency_ms_p95", F.round(p95, 4))
