"""Freshness and speed of the serving tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import health as h
from roadpulse.sources.files import path_freshness

from . import views as v
from .registry import Registry

query = Registry()


def tables(spark, sf_dir):
    return {"replay": v.replay(spark, sf_dir), "live": v.live(spark, sf_dir)}


def _anchored(now: str, seconds: int) -> str:
    return f"""
rows_ as (select 'replay' as "table", processed_time as t, inference_latency_ms as ms from replay
  union all select 'live', processed_time, end_to_end_latency_ms from live),
anchor as (select case when max(t) >= timestamp '{now}' - to_seconds({seconds}) then timestamp '{now}' else max(t) end as a,
  max(t) >= timestamp '{now}' - to_seconds({seconds}) as is_live from rows_),
inside as (select rows_.* from rows_, anchor where t >= a - to_seconds({seconds}) and t <= a)"""


STATUS = "case when {n} > 0 and is_live then 'ok' when {n} > 0 then 'stale' else 'not_enough_data' end"


def _throughput_sql(now: str, window: str, seconds: int) -> str:
    return v.with_views(
        ["replay", "live"],
        f"""
with {_anchored(now, seconds)}
select {STATUS.format(n='n')} as status, '{window}' as "window", {seconds} as window_seconds, a as window_anchor,
  is_live as is_live_window, n as event_count, round(n / ({seconds} / 60e0), 4) as events_per_minute,
  round(n / {seconds}e0, 4) as events_per_second
from (select count(*) as n from inside), anchor""",
    )


@query("throughput", _throughput_sql("2024-06-01 00:00:00", "3d", 3 * 86400))
def throughput(spark, sf_dir):
    return h.throughput(tables(spark, sf_dir), "3d", now="2024-06-01 00:00:00")


@query("throughput_live", _throughput_sql("2024-01-20 00:00:00", "36h", 36 * 3600))
def throughput_live(spark, sf_dir):
    return h.throughput(tables(spark, sf_dir), "36h", now="2024-01-20 00:00:00")


@query(
    "throughput_by_table",
    v.with_views(
        ["replay", "live"],
        f"""
with {_anchored('2024-01-20 00:00:00', 36 * 3600)}
select "table", event_count, latest_timestamp, {STATUS.format(n='event_count')} as status from (
  select "table", count(*) filter (where t >= a - to_seconds({36 * 3600}) and t <= a) as event_count,
    max(t) as latest_timestamp, any_value(is_live) as is_live from rows_, anchor group by 1)""",
    ),
)
def throughput_by_table(spark, sf_dir):
    return h.throughput_by_table(tables(spark, sf_dir), "36h", now="2024-01-20 00:00:00")


@query(
    "latency",
    v.with_views(
        ["replay", "live"],
        f"""
with {_anchored('2024-06-01 00:00:00', 30 * 365 * 86400)},
sane as (select ms from inside where ms between 0 and 3600000)
select {STATUS.format(n='n')} as status, 'p95' as metric, '10950d' as "window", a as window_anchor,
  is_live as is_live_window, round(p95, 6) as value_ms, round(p50, 6) as p50, round(p95, 6) as p95, round(p99, 6) as p99,
  round("avg" + 1e-9, 6) as avg, n as sample_count
from (select percentile_cont(0.5) within group (order by ms) as p50, percentile_cont(0.95) within group (order by ms) as p95,
  percentile_cont(0.99) within group (order by ms) as p99, avg(ms) as "avg", count(ms) as n from sane), anchor""",
    ),
)
def latency(spark, sf_dir):
    out = h.latency(tables(spark, sf_dir), "unknown", "10950d", now="2024-06-01 00:00:00")
    return out.withColumns({c: F.round(c, 6) for c in ("value_ms", "p50", "p95", "p99")}).withColumn("avg", v.near("avg"))


@query(
    "latency_by_table",
    v.with_views(
        ["replay", "live"],
        """
select "table", round(avg(ms) + 1e-9, 6) as avg, count(*) as sample_count, round(percentile_cont(0.5) within group (order by ms), 6) as p50,
  round(percentile_cont(0.95) within group (order by ms), 6) as p95, round(percentile_cont(0.99) within group (order by ms), 6) as p99
from (select 'replay' as "table", processed_time as t, end_to_end_latency_ms as ms from replay
  union all select 'live', processed_time, end_to_end_latency_ms from live) group by 1""",
    ),
)
def latency_by_table(spark, sf_dir):
    out = h.latency_by_table(
        tables(spark, sf_dir), "10950d", now="2024-06-01 00:00:00", column="end_to_end_latency_ms"
    )
    return out.withColumns({c: F.round(c, 6) for c in ("p50", "p95", "p99")}).withColumn("avg", v.near("avg"))


@query(
    "replay_health",
    v.with_views(
        ["replay", "live"],
        """
select 'replay' as "table", count(*) as row_count, max(event_time) as latest_event_time, 'ok' as status from replay
union all select 'live', count(*), max(event_time), 'ok' from live""",
    ),
)
def replay_health(spark, sf_dir):
    return h.replay_health(tables(spark, sf_dir))


@query(
    "table_report",
    v.with_views(
        ["replay"],
        """
select count(*) as rows, min(event_time) as min_event_time, max(event_time) as max_event_time,
  round(avg(end_to_end_latency_ms), 2) as avg_latency_ms,
  round(percentile_cont(0.95) within group (order by end_to_end_latency_ms), 2) as p95_latency_ms from replay""",
    ),
)
def table_report(spark, sf_dir):
    return h.table_report(v.replay(spark, sf_dir))


@query(
    "run_report",
    v.with_views(
        ["replay"],
        """
select count(*) as rows, 12.5e0 as elapsed_seconds, round(count(*) / 12.5e0, 4) as throughput_tps,
  round(avg(inference_latency_ms) + 1e-9, 4) as latency_ms_avg,
  round(percentile_cont(0.95) within group (order by inference_latency_ms), 4) as latency_ms_p95 from replay""",
    ),
)
def run_report(spark, sf_dir):
    return h.run_report(v.replay(spark, sf_dir), 12.5, column="inference_latency_ms")


@query("path_freshness")
def freshness(spark, sf_dir):
    return path_freshness(spark, sf_dir)
