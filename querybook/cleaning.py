"""Cleaning scalars, the feature contract, scores and row rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions import clean, risk
from roadpulse.operators import features as feats
from roadpulse.operators import scenarios
from roadpulse.plans import jobs
from roadpulse.schemas import FEATURE_COLUMNS, FILL_DEFAULTS

from . import views as v
from .registry import Registry

query = Registry()


@query(
    "clean_numbers",
    v.with_views(
        ["raw_replay"],
        f"""
select ID, coalesce(nullif(trim(Street), ''), 'none') as street_text,
  {v.f_sql('Start_Lat')} as lat, {v.i_sql('Severity')} as severity, {v.i_sql('Wind_Speed_mph')} as wind_int,
  {v.clip_sql('Temperature_F', 50, -40, 130)} as temperature_f, {v.clip_sql('Humidity_pct', 50, 0, 100)} as humidity,
  {v.clip_sql('Wind_Speed_mph', 0, 0, 100)} as wind_speed_mph, {v.clip_sql('Visibility_mi', 10, 0, 10)} as visibility_mi
from raw_replay""",
    ),
)
def clean_numbers(spark, sf_dir):
    c = F.col
    return v.raw_replay(spark, sf_dir).select(
        "ID",
        clean.safe_string(c("Street"), "none").alias("street_text"),
        clean.safe_float(c("Start_Lat")).alias("lat"),
        clean.safe_int(c("Severity")).alias("severity"),
        clean.safe_int(c("Wind_Speed_mph")).alias("wind_int"),
        clean.weather_number("temperature_f", c("Temperature_F")).alias("temperature_f"),
        clean.weather_number("humidity", c("Humidity_pct")).alias("humidity"),
        clean.weather_number("wind_speed_mph", c("Wind_Speed_mph")).alias("wind_speed_mph"),
        clean.weather_number("visibility_mi", c("Visibility_mi")).alias("visibility_mi"),
    )


@query(
    "clean_flags",
    v.with_views(
        ["raw_replay"],
        f"""
select ID, {v.b_sql('Junction')} as is_junction, {v.b_sql('Traffic_Signal')} as has_traffic_signal,
  {v.b_sql('Crossing')} as is_crossing, {v.b_sql('Roundabout')} as is_roundabout, {v.b_sql('Stop')} as is_stop,
  {v.b_sql('Station')} as is_station, {v.b_sql('Railway')} as is_railway,
  cast(coalesce(lower(trim(Sunrise_Sunset)) = 'night', false) as int) as is_night,
  coalesce(nullif(trim(Weather_Condition), ''), nullif(trim(Street), ''), 'nothing') as first_text
from raw_replay""",
    ),
)
def clean_flags(spark, sf_dir):
    raw = v.raw_replay(spark, sf_dir)
    return raw.select(
        "ID",
        *[clean.bool_int(F.col(source)).alias(flag) for flag, source in feats.FLAG_SOURCES.items()],
        clean.is_night(F.col("Sunrise_Sunset")).alias("is_night"),
        clean.first_non_empty(F.col("Weather_Condition"), F.col("Street"), default="nothing").alias("first_text"),
    )


@query(
    "parse_event_time",
    v.with_views(
        ["raw_replay"],
        f"""
select ID, {v.t_sql('Start_Time')} as event_time, {v.t_sql("replace(Start_Time, ' ', 'T')")} as iso_time,
  {v.t_sql("Start_Time")} - case when {v.t_sql("Start_Time")} is null then null else interval 5 hour end as utc_time,
  case when {v.t_sql("Start_Time")} is null then null else
    date_trunc('hour', {v.t_sql("Start_Time")} - interval 5 hour) end as utc_hour
from raw_replay""",
    ),
)
def parse_event_time(spark, sf_dir):
    c = F.col("Start_Time")
    zoned = F.concat(c, F.lit("+05:00"))
    return v.raw_replay(spark, sf_dir).select(
        "ID",
        clean.parse_event_time(c).alias("event_time"),
        clean.norm_ts(F.concat(F.replace(c, F.lit(" "), F.lit("T")), F.lit("Z"))).alias("iso_time"),
        clean.to_utc(zoned).alias("utc_time"),
        clean.utc_hour(zoned).alias("utc_hour"),
    )


@query(
    "time_features",
    v.with_views(
        ["raw_parsed"],
        f"""
select ID, cast(extract(year from t) as int) as event_year, {v._FEATURE_TAIL},
  case when extract(hour from t) >= 22 or extract(hour from t) < 6 then 'Night' else 'Day' end as light
from raw_parsed""",
    ),
)
def time_features(spark, sf_dir):
    t = clean.parse_event_time(F.col("Start_Time"))
    return v.raw_replay(spark, sf_dir).select(
        "ID",
        F.year(t).alias("event_year"),
        F.hour(t).alias("hour"),
        F.dayofweek(t).alias("day_of_week"),
        clean.is_weekend(F.dayofweek(t)).alias("is_weekend"),
        clean.is_rush_hour(F.hour(t)).alias("is_rush_hour"),
        clean.infer_light(F.col("Start_Time")).alias("light"),
    )


@query(
    "weather_code",
    v.with_views(
        ["raw_replay"],
        f"select ID, {v.rules_sql('Weather_Condition', v.WEATHER_RULES)} as weather_code from raw_replay",
    ),
)
def weather_code(spark, sf_dir):
    return v.raw_replay(spark, sf_dir).select(
        "ID", clean.weather_code(F.col("Weather_Condition")).alias("weather_code")
    )


@query(
    "weather_label",
    """
select event_id, case when event_id % 100 in (95, 96, 99) then 'Thunderstorm'
  when event_id % 100 in (71, 73, 75, 77, 85, 86) then 'Snow'
  when event_id % 100 in (51, 53, 55, 56, 57, 61, 63, 65, 66, 67, 80, 81, 82) then 'Rain'
  when event_id % 100 in (45, 48) then 'Fog' when event_id % 100 in (1, 2, 3) then 'Cloudy'
  else 'Clear' end as label
from events""",
)
def weather_label(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", clean.weather_label(F.col("event_id") % 100).alias("label"))


@query(
    "road_type_code",
    v.with_views(
        ["raw_replay"], f"select ID, {v.rules_sql('Street', v.ROAD_RULES)} as road_type_code from raw_replay"
    ),
)
def road_type_code(spark, sf_dir):
    return v.raw_replay(spark, sf_dir).select("ID", clean.road_type_code(F.col("Street")).alias("road_type_code"))


@query("build_features", v.with_views(["features"], f"select {', '.join(FEATURE_COLUMNS)} from features"))
def build_features(spark, sf_dir):
    return v.features(spark, sf_dir)


@query(
    "reject_reasons",
    v.with_views(
        ["raw_parsed"],
        """
select reject_reason, count(*) as n from (
  select case when t is null then 'bad_time' when plat is null or plon is null then 'bad_coordinate'
    when sev is null then 'bad_severity' when coalesce(trim(ID), '') = '' then 'missing_id'
    when isnan(plat) or isnan(plon) or not (plat between -90 and 90 and plon between -180 and 180)
      then 'coordinate_out_of_range'
    when sev not between 1 and 4 then 'severity_out_of_range' end as reject_reason
  from raw_parsed)
where reject_reason is not null group by reject_reason""",
    ),
)
def reject_reasons(spark, sf_dir):
    _, bad = feats.split_valid(v.raw_replay(spark, sf_dir))
    return bad.groupBy("reject_reason").agg(F.count("*").alias("n"))


@query(
    "scan_report",
    v.with_views(
        ["raw_replay", "features"],
        """
select (select count(*) from raw_replay) as rows_read, (select count(*) from features) as valid_rows,
  (select count(*) from raw_replay) - (select count(*) from features) as dropped_rows""",
    ),
)
def scan_report(spark, sf_dir):
    return feats.scan_report(v.raw_replay(spark, sf_dir))


@query(
    "risk_write",
    v.with_views(
        ["features"],
        f"""
select event_id, {v.write_risk_sql('true_severity')} as risk_score,
  {v.write_risk_sql('predicted_severity', 'k % 900', 'k % 2000')} as risk_with_delay
from features""",
    ),
)
def risk_write(spark, sf_dir):
    k = F.substr(F.col("event_id"), F.lit(3)).cast("bigint")
    rows = feats.build_features(v.raw_replay(spark, sf_dir), keep=["predicted_severity"])
    return rows.select(
        "event_id",
        risk.context_risk(F.col("true_severity")).alias("risk_score"),
        risk.context_risk(F.col("predicted_severity"), k % 900, k % 2000).alias("risk_with_delay"),
    )


@query(
    "risk_read_replay",
    v.with_views(
        ["replay"],
        f"""
select event_id,
  {v.read_risk_sql('risk_score', 'coalesce(predicted_severity, true_severity)')} as effective_risk
from replay""",
    ),
)
def risk_read_replay(spark, sf_dir):
    return v.replay(spark, sf_dir).select("event_id", risk.effective_risk_replay().alias("effective_risk"))


@query(
    "risk_read_live",
    v.with_views(
        ["live"],
        f"""
select event_id,
  {v.read_risk_sql('risk_score', 'severity', 'delay_seconds', 'length_meters')} as effective_risk
from live""",
    ),
)
def risk_read_live(spark, sf_dir):
    return v.live(spark, sf_dir).select("event_id", risk.effective_risk_live().alias("effective_risk"))


@query(
    "risk_level",
    v.with_views(
        ["all_points"],
        """
select event_id, case when coalesce(risk_score, 0) >= 0.7e0 then 'high'
  when coalesce(risk_score, 0) >= 0.4e0 then 'medium' else 'low' end as risk_level,
  greatest(0.05e0, risk_score) as heat_weight
from all_points where risk_score >= 0.1e0""",
    ),
)
def risk_level(spark, sf_dir):
    from roadpulse.operators.serving import common_view, min_risk

    rows = min_risk(common_view(v.sources(spark, sf_dir)), 0.1)
    score = F.col("risk_score")
    return rows.select(
        "event_id", risk.risk_level(score).alias("risk_level"), risk.heat_weight(score).alias("heat_weight")
    )


@query(
    "live_severity",
    """
select event_id, cast(greatest(
  case when event_id % 7 >= 4 then 4 when event_id % 7 in (2, 3) then event_id % 7 else 1 end,
  case event_id % 12 when 8 then 4 when 1 then 3 when 9 then 2 else 1 end) as int) as severity
from events""",
)
def live_severity(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = F.col("event_id")
    return events.select("event_id", risk.live_severity((n % 7).cast("int"), (n % 12).cast("int")).alias("severity"))


@query(
    "infer_severity",
    """
select event_id, cast(case when a is not null and a <> 0 then greatest(1, least(4, a))
    when b is not null and b <> 0 then greatest(1, least(4, b))
    when c is not null and c <> 0 then greatest(1, least(4, c))
    when d is not null then greatest(1, least(4, d))
    when p1 >= coalesce(p2, -1) and p1 >= coalesce(p3, -1) and p1 >= coalesce(p4, -1) then 1
    when p2 >= coalesce(p3, -1) and p2 >= coalesce(p4, -1) then 2
    when p3 >= coalesce(p4, -1) then 3 else 4 end as int) as severity
from (select event_id, case when event_id % 3 = 0 then event_id % 6 end as a,
  case when event_id % 4 = 0 then event_id % 5 end as b, case when event_id % 9 = 1 then 0 end as c,
  case when event_id % 7 = 2 then event_id % 2 end as d,
  (event_id * 13 % 20) / 20e0 as p1, (event_id * 7 % 20) / 20e0 as p2, (event_id * 11 % 20) / 20e0 as p3,
  case when event_id % 2 = 0 then (event_id * 3 % 20) / 20e0 end as p4 from events)""",
)
def infer_severity(spark, sf_dir):
    n = F.col("event_id")
    chance = lambda m: (n * m % 20) / F.lit(20.0)
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        risk.infer_severity(
            F.when(n % 3 == 0, n % 6), F.when(n % 4 == 0, n % 5), F.when(n % 9 == 1, F.lit(0)),
            F.when(n % 7 == 2, n % 2),
            [chance(13), chance(7), chance(11), F.when(n % 2 == 0, chance(3))],
        ).alias("severity"),
    )


@query(
    "score_with_fallback",
    v.with_views(
        ["features"],
        f"""
select event_id, coalesce({v.write_risk_sql('predicted_severity')}, {v.write_risk_sql('true_severity')}, 0.25e0)
  as risk_score, case when predicted_severity is not null then 'ok' else 'failed' end as model_status
from features""",
    ),
)
def score_with_fallback(spark, sf_dir):
    rows = feats.build_features(v.raw_replay(spark, sf_dir), keep=["predicted_severity"])
    score, status = risk.score_with_fallback()
    return rows.select("event_id", score.alias("risk_score"), status.alias("model_status"))


HEURISTIC_SQL = """
greatest(0e0, least(1e0, 0.18e0 + case when is_rush_hour = 1 then 0.20e0 else 0e0 end
  + case when is_night = 1 then 0.12e0 else 0e0 end + case when is_junction = 1 then 0.10e0 else 0e0 end
  + case when is_crossing = 1 then 0.08e0 else 0e0 end + case when has_traffic_signal = 1 then 0.08e0 else 0e0 end
  + case when weather_code in (1, 2, 3, 4, 6) then 0.10e0 else 0e0 end
  + greatest(0e0, (10e0 - visibility_mi) / 10e0) * 0.18e0
  + least(greatest(wind_speed_mph, 0e0), 100e0) / 100e0 * 0.10e0))"""
HEURISTIC_CLASS = (
    f"case when {HEURISTIC_SQL} >= 0.75e0 then 4 when {HEURISTIC_SQL} >= 0.5e0 then 3"
    f" when {HEURISTIC_SQL} >= 0.25e0 then 2 else 1 end"
)


@query(
    "heuristic_severity",
    v.with_views(
        ["features"],
        f"""
select event_id, predicted_severity, {v.write_risk_sql('predicted_severity')} as risk_score from (
  select * replace ({HEURISTIC_CLASS} as predicted_severity) from features)""",
    ),
)
def heuristic_severity(spark, sf_dir):
    scored = v.features(spark, sf_dir).withColumn("predicted_severity", risk.heuristic_severity())
    return scored.select(
        "event_id", "predicted_severity", risk.context_risk(F.col("predicted_severity")).alias("risk_score")
    )


_FLOATS = ("temperature_f", "humidity", "wind_speed_mph", "visibility_mi")


def _gold_column(c: str) -> str:
    value = f"case when k % 5 = 0 then null else {c} end" if c in ("humidity", "hour") else c
    if c in _FLOATS:
        value = f"cast({value} as float)"
    return f"coalesce({value}, 0) as {c}" if c in FILL_DEFAULTS else f"{value} as {c}"


@query(
    "gold_clean",
    v.with_views(
        ["features"],
        f"""
select event_id, event_year, event_time, true_severity, lat, lon, {', '.join(_gold_column(c) for c in FILL_DEFAULTS)}
from (
  select * replace ('A-' || cast(k // 2 as varchar) as event_id,
    strftime(event_time, '%Y-%m-%dT%H:%M:%S') as event_time) from features where k % 31 <> 0)
qualify row_number() over (partition by event_id order by event_time desc, k desc) = 1""",
    ),
)
def gold_clean(spark, sf_dir):
    """Silver rows with doubled ids, holes and invalid rows, cleaned for Gold."""
    k = F.substr(F.col("event_id"), F.lit(3)).cast("bigint")
    silver = v.features(spark, sf_dir).withColumn("k", k)
    hole = lambda c: F.when(F.col("k") % 5 != 0, F.col(c))
    silver = silver.withColumns(
        {
            "event_id": F.concat(F.lit("A-"), F.floor(F.col("k") / 2).cast("string")),
            "true_severity": F.when(F.col("k") % 31 != 0, F.col("true_severity")),
            "humidity": hole("humidity"),
            "hour": hole("hour"),
        }
    )
    return jobs.gold_clean(feats.to_contract(silver, keep=["k"]), order_by=["event_time", "k"]).drop("k")


@query(
    "scenario_rules",
    v.with_views(
        ["features"],
        """
select event_id, array_to_string(list_filter([
    case when not (hour + k % 4 between 0 and 23) then 'hour' end,
    case when not (day_of_week - k % 3 between 1 and 7) then 'day_of_week' end,
    case when not (is_junction + k % 2 between 0 and 1) then 'is_junction' end], lambda x: x is not null), ',')
  as violations
from features""",
    ),
)
def scenario_rules(spark, sf_dir):
    k = F.substr(F.col("event_id"), F.lit(3)).cast("bigint")
    rows = v.features(spark, sf_dir).withColumns(
        {
            "hour": F.col("hour") + k % 4,
            "day_of_week": F.col("day_of_week") - k % 3,
            "is_junction": F.col("is_junction") + k % 2,
        }
    )
    return scenarios.check_scenario(rows).select("event_id", F.array_join("violations", ",").alias("violations"))
