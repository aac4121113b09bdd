"""Serving queries: points, latest rows, details, hotspots, neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import hotspots as hot
from roadpulse.operators import serving as sv

from . import views as v
from .registry import Registry

query = Registry()

LEVEL = (
    "case when coalesce(risk_score, 0) >= 0.7e0 then 'high' when coalesce(risk_score, 0) >= 0.4e0 then 'medium'"
    " else 'low' end"
)
POINTS = (
    "event_id, lat, lon, risk_score, predicted_severity, true_severity, event_time,"
    " coalesce(nullif(model_status, ''), 'unknown') as model_status, data_source, marker_shape,"
    f" {LEVEL} as risk_level"
)


def _newest_sql(source: str, where: str, limit: int) -> str:
    share = -(-limit // 2)
    part = lambda label: (
        f"(select * from {source} where data_source = '{label}' and {where}"
        f" order by event_time desc nulls last, event_id limit {share})"
    )
    return (
        f"select {POINTS} from ({part('replay')} union all {part('live')})"
        f" order by event_time desc nulls last, event_id limit {limit}"
    )


@query(
    "map_points",
    v.with_views(
        ["all_points"],
        _newest_sql(
            "all_points",
            "risk_score >= 0.3e0 and lon between -125 and -66 and lat between 24 and 49"
            " and event_time >= timestamp '1996-01-01' and event_time <= timestamp '2024-12-31'",
            500,
        ),
    ),
)
def map_points(spark, sf_dir):
    return sv.map_points(
        v.sources(spark, sf_dir), bbox="-125,24,-66,49", min_risk_score=0.3, start="1996-01-01 00:00:00",
        end="2024-12-31 00:00:00", limit=500,
    )


@query("latest_predictions", v.with_views(["all_points"], _newest_sql("all_points", "true", 100)))
def latest_predictions(spark, sf_dir):
    return sv.latest_predictions(v.sources(spark, sf_dir), limit=100)


@query(
    "latest_replay",
    v.with_views(
        ["all_points"],
        f"select {POINTS} from all_points where data_source = 'replay'"
        " order by event_time desc nulls last, event_id limit 40",
    ),
)
def latest_replay(spark, sf_dir):
    return sv.latest_predictions(v.sources(spark, sf_dir), limit=40, mode="replay")


@query(
    "event_detail",
    v.with_views(
        ["all_points"],
        f"select {POINTS}, cast(null as timestamp) as created_at from all_points where event_id = 'live-77'",
    ),
)
def event_detail(spark, sf_dir):
    return sv.event_detail(v.sources(spark, sf_dir), "live-77")


@query(
    "serving_union",
    v.with_views(
        ["all_points"],
        """
select data_source, marker_shape, count(*) as n, round(sum(risk_score), 4) as risk, sum(cast(is_severe as int)) as severe
from all_points where event_time >= timestamp '1997-01-01' group by data_source, marker_shape""",
    ),
)
def serving_union(spark, sf_dir):
    rows = sv.time_range(sv.common_view(v.sources(spark, sf_dir)), start="1997-01-01 00:00:00")
    return rows.groupBy("data_source", "marker_shape").agg(
        F.count("*").alias("n"), F.round(F.sum("risk_score"), 4).alias("risk"), F.count_if("is_severe").alias("severe")
    )


@query(
    "in_bbox",
    v.with_views(
        ["all_points"],
        "select event_id, lat, lon from all_points where lon between -74.1e0 and -73.9e0 and lat between 40.4e0 and 40.7e0",
    ),
)
def in_bbox(spark, sf_dir):
    points = sv.common_view(v.sources(spark, sf_dir)).select("event_id", "lat", "lon")
    return sv.in_bbox(points, "-74.1,40.4,-73.9,40.7")


@query(
    "latest_timestamp",
    v.with_views(["all_points"], "select data_source, max(event_time) as latest_time from all_points group by 1"),
)
def latest_timestamp(spark, sf_dir):
    return sv.common_view(v.sources(spark, sf_dir)).groupBy("data_source").agg(F.max("event_time").alias("latest_time"))


CELLS = """
cells as (
  select data_source, round(lat, 3) as center_lat, round(lon, 3) as center_lon, avg(risk_score) as avg_risk,
    count(*) as accident_count, cast(sum(cast(is_severe as int)) as bigint) as severe_count
  from chosen where lat is not null and lon is not null and risk_score is not null
  group by all having count(*) >= {min_events}),
modes as (
  select data_source, round(lat, 3) as center_lat, round(lon, 3) as center_lon, hour as peak_hour
  from chosen where risk_score is not null group by 1, 2, 3, 4
  qualify row_number() over (partition by data_source, round(lat, 3), round(lon, 3)
    order by count(*) desc, hour) = 1),
joined as (select * from cells join modes using (data_source, center_lat, center_lon))"""
RANKED = """
select cast(row_number() over (order by round(avg_risk, 10) desc, accident_count desc, data_source, center_lat,
    center_lon) as int) as rank,
  center_lat, center_lon, round(avg_risk + 1e-9, 6) as avg_risk_score, accident_count, severe_count, peak_hour, data_source
from picked order by rank"""
CUT = (
    "(select * from joined where data_source = '{label}' order by round(avg_risk, 10) desc, accident_count desc,"
    " center_lat, center_lon limit {n})"
)


def _round_avg(df):
    return df.withColumn("avg_risk_score", v.near("avg_risk_score"))


@query(
    "hotspots",
    v.with_views(
        ["features"],
        f"with chosen as (select *, 'replay' as data_source, {v.write_risk_sql('true_severity')} as risk_score,"
        f" true_severity >= 3 as is_severe from features), {CELLS.format(min_events=5)},"
        " picked as (select * from joined order by round(avg_risk, 10) desc, accident_count desc, center_lat,"
        f" center_lon limit 50) {RANKED.replace(', data_source', '')}",
    ),
)
def hotspots(spark, sf_dir):
    """Raw rows to hotspots in one plan: parse, clean, score, group, rank."""
    from roadpulse.functions.risk import context_risk

    rows = v.features(spark, sf_dir).select(
        "lat", "lon", "hour", context_risk(F.col("true_severity")).alias("risk_score"),
        (F.col("true_severity") >= 3).alias("is_severe"),
    )
    return _round_avg(hot.ranked(hot.hotspots(rows, 5), ["center_lat", "center_lon"], 50))


@query(
    "top_hotspots_full",
    v.with_views(
        ["all_points"],
        f"with chosen as (select * from all_points where event_time >= timestamp '1995-01-01'), {CELLS.format(min_events=5)},"
        f" parts as ({CUT.format(label='replay', n=30)} union all {CUT.format(label='live', n=30)}),"
        " picked as (select * from parts order by round(avg_risk, 10) desc, accident_count desc, data_source, center_lat,"
        f" center_lon limit 20) {RANKED}",
    ),
)
def top_hotspots_full(spark, sf_dir):
    return _round_avg(hot.top_hotspots(v.sources(spark, sf_dir), limit=20, start="1995-01-01 00:00:00"))


@query(
    "top_hotspots_default_range",
    v.with_views(
        ["all_points"],
        "with latest as (select data_source, max(event_time) as t from all_points group by 1),"
        " chosen as (select a.* from all_points a join latest l using (data_source)"
        "  where event_time <= t and event_time >= t - case data_source when 'replay' then interval 7 day"
        f"   else interval 24 hour end), {CELLS.format(min_events=2)},"
        f" parts as ({CUT.format(label='replay', n=30)} union all {CUT.format(label='live', n=30)}),"
        " picked as (select * from parts order by round(avg_risk, 10) desc, accident_count desc, data_source, center_lat,"
        f" center_lon limit 20) {RANKED}",
    ),
)
def top_hotspots_default_range(spark, sf_dir):
    return _round_avg(hot.top_hotspots(v.sources(spark, sf_dir), limit=20, min_events=2))


@query(
    "hotspot_detail",
    v.with_views(
        ["all_points"],
        "with latest as (select data_source, max(event_time) as t from all_points group by 1),"
        " chosen as (select a.* from all_points a join latest l using (data_source)"
        "  where event_time <= t and event_time >= t - case data_source when 'replay' then interval 7 day"
        f"   else interval 24 hour end), {CELLS.format(min_events=5)},"
        f" parts as ({CUT.format(label='replay', n=6)} union all {CUT.format(label='live', n=6)}),"
        " picked as (select * from parts order by round(avg_risk, 10) desc, accident_count desc, data_source, center_lat,"
        f" center_lon limit 3) select * from ({RANKED}) where rank = 3",
    ),
)
def hotspot_detail(spark, sf_dir):
    return _round_avg(hot.hotspot_detail(v.sources(spark, sf_dir), 3))


HAVERSINE = """
2 * 6371008.8e0 * asin(least(1e0, sqrt(
  sin(radians(lat - {lat}) / 2) * sin(radians(lat - {lat}) / 2)
  + cos(radians({lat})) * cos(radians(lat)) * sin(radians(lon - {lon}) / 2) * sin(radians(lon - {lon}) / 2))))"""


@query(
    "nearby",
    v.with_views(
        ["all_points"],
        f"""
select event_id, lat, lon, risk_score, round(d, 4) as distance_m from (
  select *, {HAVERSINE.format(lat='35.0e0', lon='-100.0e0')} as d from all_points where data_source = 'replay')
where d <= 120000 order by d, event_id limit 100""",
    ),
)
def nearby(spark, sf_dir):
    found = hot.nearby(v.replay(spark, sf_dir), 35.0, -100.0, radius_m=120_000.0, limit=100)
    return found.withColumn("distance_m", F.round("distance_m", 4))


@query(
    "nearby_flat",
    v.with_views(
        ["all_points"],
        """
select event_id, lat, lon, risk_score, round(d, 4) as distance_m from (
  select *, 111320e0 * sqrt(power(lat - 35.02e0, 2) + power((lon + 100.03e0) * cos(radians(35.02e0)), 2)) as d
  from all_points where data_source = 'replay')
where d <= 50000 order by d, event_id limit 50""",
    ),
)
def nearby_flat(spark, sf_dir):
    found = hot.nearby(v.replay(spark, sf_dir), 35.02, -100.03, radius_m=50_000.0, limit=50, method="flat")
    return found.withColumn("distance_m", F.round("distance_m", 4))


@query(
    "nearby_join",
    v.with_views(
        ["live"],
        f"""
with centers as (select 'c' || user_id as center_id, avg(40.4e0 + (user_id % 50) / 1e2) as clat,
    avg(-74.2e0 + (user_id % 37) / 1e2) as clon from events group by user_id)
select center_id, count(*) as n, round(sum(d), 2) as total_distance from (
  select center_id, event_id, {HAVERSINE.format(lat='clat', lon='clon')} as d from live, centers
  where lat between clat - 0.1e0 and clat + 0.1e0)
where d <= 5000 group by center_id""",
    ),
)
def nearby_join(spark, sf_dir):
    events = v.live(spark, sf_dir).select("event_id", "lat", "lon")
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct()
    centers = users.select(
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("center_id"),
        (F.lit(40.4) + F.col("user_id") % 50 / 100).alias("center_lat"),
        (F.lit(-74.2) + F.col("user_id") % 37 / 100).alias("center_lon"),
    )
    return hot.nearby_totals(events, centers, 5000.0).withColumn("total_distance", F.round("total_distance", 2))


@query(
    "nearby_salted",
    v.with_views(
        ["live"],
        f"""
with centers as (select distinct 'c' || user_id as center_id, 40.4e0 + (user_id % 50) / 1e2 as clat,
    -74.2e0 + (user_id % 40) / 1e2 as clon from events)
select event_id, count(*) as n from (
  select event_id, {HAVERSINE.format(lat='clat', lon='clon')} as d from live, centers
  where lat between clat - 0.1e0 and clat + 0.1e0)
where d <= 2000 group by event_id""",
    ),
)
def nearby_salted(spark, sf_dir):
    """Centres near each event."""
    events = v.live(spark, sf_dir).select("event_id", "lat", "lon")
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct()
    centers = users.select(
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("center_id"),
        (F.lit(40.4) + F.col("user_id") % 50 / 100).alias("center_lat"),
        (F.lit(-74.2) + F.col("user_id") % 40 / 100).alias("center_lon"),
    )
    return hot.centers_around(events, centers, 2000.0)


@query(
    "nearest_per_center",
    v.with_views(
        ["live"],
        f"""
with centers as (select distinct 'c' || user_id as center_id, 40.4e0 + (user_id % 50) / 1e2 as clat,
    -74.2e0 + (user_id % 37) / 1e2 as clon from events)
select center_id, event_id, round(d, 4) as distance_m,
  cast(row_number() over (partition by center_id order by d, event_id) as int) as rank from (
  select center_id, event_id, {HAVERSINE.format(lat='clat', lon='clon')} as d from live, centers
  where lat between clat - 0.1e0 and clat + 0.1e0)
where d <= 5000 qualify rank <= 3""",
    ),
)
def nearest_per_center(spark, sf_dir):
    events = v.live(spark, sf_dir).select("event_id", "lat", "lon")
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct()
    centers = users.select(
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("center_id"),
        (F.lit(40.4) + F.col("user_id") % 50 / 100).alias("center_lat"),
        (F.lit(-74.2) + F.col("user_id") % 37 / 100).alias("center_lon"),
    )
    found = hot.nearest_per_center(events, centers, 5000.0, 3)
    return found.select("center_id", "event_id", F.round("distance_m", 4).alias("distance_m"), "rank")


@query(
    "extent",
    v.with_views(
        ["all_points"],
        """
select min(lon) as min_lon, max(lon) as max_lon, min(lat) as min_lat, max(lat) as max_lat,
  (min(lon) + max(lon)) / 2 as center_lon, (min(lat) + max(lat)) / 2 as center_lat,
  greatest(8e0, max(lon) - min(lon)) as lon_span, greatest(6e0, max(lat) - min(lat)) as lat_span
from all_points where data_source = 'live'""",
    ),
)
def extent(spark, sf_dir):
    return hot.extent(sv.common_view(v.sources(spark, sf_dir), "live"))


@query(
    "sql_views",
    v.with_views(
        ["replay", "live", "features"],
        """
select 'replay' as name, count(*) as n, max(event_time) as latest from replay union all
select 'live', count(*), max(event_time) from live union all select 'gold', count(*), max(event_time) from features""",
    ),
)
def sql_views(spark, sf_dir):
    """The three tables asked in SQL."""
    sv.create_views(v.sources(spark, sf_dir), v.feature_table(spark, sf_dir))
    return spark.sql(" union all ".join(f"select '{n}' as name, count(*) as n, max(event_time) as latest from {n}" for n in ("replay", "live", "gold")))
