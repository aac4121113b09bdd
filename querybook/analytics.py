"""Grouped metrics over the serving tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import analytics as an

from . import views as v
from .registry import Registry

query = Registry()


def _rounded(df, *columns):
    return df.withColumns({c: v.near(c) for c in columns})


def _series_sql(part: str, where: str, value: str) -> str:
    return v.with_views(
        ["all_points"],
        f"""
select cast(date_trunc('{part}', event_time) as date) as time, {value} as value,
  round(avg(risk_score) + 1e-9, 6) as avg_risk_score, count(*) as accident_count,
  count(*) filter (where risk_score >= 0.7e0) as high_risk_count
from all_points where data_source = 'replay' and risk_score is not null and {where} group by 1""",
    )


@query("timeseries_day", _series_sql("day", "true", "round(avg(risk_score) + 1e-9, 6)"))
def timeseries_day(spark, sf_dir):
    return _rounded(an.timeseries(v.replay(spark, sf_dir), "day"), "avg_risk_score", "value")


@query(
    "timeseries_month",
    _series_sql(
        "month", "event_time >= timestamp '1996-03-01' and event_time <= timestamp '1998-06-30'",
        "cast(count(*) filter (where risk_score >= 0.7e0) as double)",
    ),
)
def timeseries_month(spark, sf_dir):
    series = an.timeseries(
        v.replay(spark, sf_dir), "month", "high_risk_count", "1996-03-01 00:00:00", "1998-06-30 00:00:00"
    )
    return _rounded(series, "avg_risk_score")


@query("timeseries_year", _series_sql("year", "true", "cast(count(*) as double)"))
def timeseries_year(spark, sf_dir):
    return _rounded(an.timeseries(v.replay(spark, sf_dir), "year", "count"), "avg_risk_score")


@query(
    "severity_distribution",
    v.with_views(
        ["all_points"],
        "select true_severity as severity, count(*) as count from all_points where true_severity is not null group by 1",
    ),
)
def severity_distribution(spark, sf_dir):
    return an.severity_distribution(v.sources(spark, sf_dir))


@query(
    "risk_by_hour",
    v.with_views(
        ["all_points"],
        "select hour, round(avg(risk_score) + 1e-9, 6) as avg_risk_score, count(*) as accident_count from all_points"
        " where hour is not null and risk_score is not null group by 1",
    ),
)
def risk_by_hour(spark, sf_dir):
    return _rounded(an.risk_by_hour(v.sources(spark, sf_dir)), "avg_risk_score")


@query(
    "risk_by_weather",
    v.with_views(
        ["replay"],
        f"""
select weather_code, round(avg(r) + 1e-9, 6) as avg_risk_score, count(*) as accident_count from (
  select weather_code, {v.read_risk_sql('risk_score', 'coalesce(predicted_severity, true_severity)')} as r from replay)
where r is not null group by 1""",
    ),
)
def risk_by_weather(spark, sf_dir):
    return _rounded(an.risk_by_weather(v.replay(spark, sf_dir)), "avg_risk_score")


@query(
    "weather_histogram",
    v.with_views(
        ["all_points"],
        """
with long as (
  select 'temperature' as metric, temperature_f as value, 130e0 as top from all_points union all
  select 'humidity', humidity, 100e0 from all_points union all select 'wind_speed', wind_speed_mph, 100e0 from all_points)
select metric, least(9, greatest(0, cast(floor(8 * value / top) as int) + 1)) as bin_idx, min(value) as bin_min,
  max(value) as bin_max, count(*) as count,
  format('{:.0f}', min(value)) || '-' || format('{:.0f}', max(value)) as bin
from long where value is not null group by 1, 2""",
    ),
)
def weather_histogram(spark, sf_dir):
    return an.weather_histogram(v.sources(spark, sf_dir))


def _overview_sql(mode: str, only: str = "") -> str:
    return v.with_views(
        ["all_points"],
        f"""
with part as (select data_source, count(*) as n, count(*) filter (where risk_score >= 0.7e0) as high,
    coalesce(avg(risk_score), 0) as a, max(event_time) as t from all_points{only} group by 1)
select cast(sum(n) as bigint) as total_events, cast(sum(high) as bigint) as high_risk_events,
  round(sum(a * n) / sum(n), 4) as avg_risk_score, max(t) as latest_event_time, '{mode}' as mode from part""",
    )


@query("overview_exact", _overview_sql("full"))
def overview_exact(spark, sf_dir):
    return an.overview(v.sources(spark, sf_dir))


@query("overview_replay", _overview_sql("replay", " where data_source = 'replay'"))
def overview_replay(spark, sf_dir):
    return an.overview(v.sources(spark, sf_dir), "replay")


@query("overview_live", _overview_sql("live", " where data_source = 'live'"))
def overview_live(spark, sf_dir):
    return an.overview(v.sources(spark, sf_dir), "live")
