"""Incident-shaped views over the given tables, as Spark DataFrames and as SQL for the oracle.

The adapter texts run unchanged in both engines. ``SQL`` holds one common table expression per
name; ``with_views`` puts the needed ones in front of an oracle query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions import clean
from roadpulse.functions.risk import context_risk, score_with_fallback
from roadpulse.operators.features import build_features, enrich_live
from roadpulse.operators.serving import Sources
from roadpulse.schemas import LIVE_COLUMNS, REPLAY_COLUMNS
from roadpulse.session import shared_folder, tuned
from roadpulse.sources.files import spread

SPLIT_YEAR = 1998

RAW_REPLAY = """
select 'A-' || cast(o_orderkey as string) as ID,
  case when o_orderkey % 83 = 0 then '7' when o_orderkey % 100 < 2 then '1'
       when o_orderkey % 100 < 70 then '2' when o_orderkey % 100 < 95 then '3' else '4' end as Severity,
  case when o_orderkey % 89 = 0 then ''
       when o_orderkey % 107 = 0 then 'not-a-time'
       else cast(cast(o_orderdate as date) as string) || ' '
         || lpad(cast((o_orderkey * 7 + o_custkey) % 24 as string), 2, '0') || ':'
         || lpad(cast(o_orderkey % 60 as string), 2, '0') || ':00' end as Start_Time,
  case when o_orderkey % 97 = 0 then 'abc' when o_orderkey % 101 = 0 then '95.5'
       else cast(25e0 + (o_custkey % 240) / 1e1 as string) end as Start_Lat,
  cast(-120e0 + (o_custkey % 60) / 2e0 as string) as Start_Lng,
  case o_orderkey % 9 when 0 then 'Thunderstorm' when 1 then 'Light Rain' when 2 then 'Snow / Windy'
       when 3 then 'Fog' when 4 then 'Mostly Cloudy' when 5 then 'Windy' when 6 then 'Clear'
       when 7 then null else '  ' end as Weather_Condition,
  case when o_orderkey % 11 = 0 then '' when o_orderkey % 113 = 0 then 'nan'
       else cast(o_totalprice / 2e3 - 60e0 as string) end as Temperature_F,
  case when o_orderkey % 13 = 0 then null else cast(o_custkey % 130 as string) end as Humidity_pct,
  case when o_orderkey % 17 = 0 then '822.8' else cast(o_custkey % 40 as string) end as Wind_Speed_mph,
  case when o_orderkey % 19 = 0 then 'x' else cast((o_custkey % 24) / 2e0 as string) end as Visibility_mi,
  case o_custkey % 9 when 0 then 'I-75 N' when 1 then 'US-101 N' when 2 then 'Main Street'
       when 3 then 'Broadway Avenue' when 4 then 'Sunset Blvd' when 5 then 'Lake Dr'
       when 6 then 'County Rd' when 7 then 'N State Rd' else '' end as Street,
  case when o_orderkey % 5 = 0 then ' TRUE ' when o_orderkey % 5 = 1 then 'yes' else 'False' end as Junction,
  case when o_custkey % 4 = 0 then '1' else '0' end as Traffic_Signal,
  case when o_custkey % 6 = 0 then 'True' else 'False' end as Crossing,
  case when o_custkey % 50 = 0 then 'y' else 'n' end as Roundabout,
  case when o_custkey % 7 = 0 then 'True' else null end as Stop,
  case when o_custkey % 20 = 0 then 'True' else 'False' end as Station,
  case when o_custkey % 30 = 0 then 'True' else 'False' end as Railway,
  case when o_orderkey % 3 = 0 then 'Night' when o_orderkey % 3 = 1 then 'Day' else null end as Sunrise_Sunset,
  case o_orderkey % 10 when 0 then null when 1 then 2 when 2 then 3 else 1 + o_custkey % 4 end as predicted_severity,
  o_custkey % 900 + (o_orderkey % 1000) / 1e1 as inference_latency_ms
from orders
"""

LIVE_BASE = """
select 'live-' || cast(event_id as string) as event_id,
  'inc-' || cast(user_id as string) as incident_id,
  event_id as seq,
  ts as event_time,
  40.4e0 + (user_id % 50) / 1e2 as latitude,
  -74.2e0 + (user_id % 40) / 1e2 as longitude,
  cast(event_id % 6 as int) as delay_magnitude,
  cast(event_id % 12 as int) as icon_category,
  value * 4e0 as delay_seconds,
  case when event_id % 14 = 0 then null else value * 10e0 end as length_meters,
  case when event_id % 4 = 0 then '' else 'I-95 N' end as from_road,
  case when event_id % 4 = 0 then 'Park Avenue' else null end as to_road,
  event_type
from events
"""

HOURLY_WEATHER = """
select distinct
  round(40.4e0 + (user_id % 50) / 1e2, 2) as cell_lat,
  round(-74.2e0 + (user_id % 40) / 1e2, 2) as cell_lon,
  cast(ts as date) as obs_date,
  date_trunc('hour', ts) as slot,
  cast(extract(hour from ts) * 7 % 100 as int) as weather_code,
  30e0 + extract(hour from ts) * 2e0 as temperature_f,
  cast(40 + extract(hour from ts) as int) as humidity,
  extract(hour from ts) / 2e0 as wind_speed_mph
from events
where extract(hour from ts) % 3 = 0
"""

# Oracle side -------------------------------------------------------------------------------------

NUMBER = (
    "'^[+-]?((\\d+(_\\d+)*\\.?(\\d+(_\\d+)*)?|\\.\\d+(_\\d+)*)(e[+-]?\\d+)?|nan|inf|infinity)$'"
)


def f_sql(c: str) -> str:
    """Lenient text to double."""
    return f"case when regexp_full_match(lower(trim({c})), {NUMBER}) then try_cast(trim({c}) as double) end"


def i_sql(c: str) -> str:
    """Lenient text to int, fraction cut."""
    return f"try_cast(trunc({f_sql(c)}) as int)"


def clip_sql(c: str, default: float, low: float, high: float) -> str:
    value = f"coalesce({f_sql(c)}, {default})"
    return f"case when isnan({value}) then {high}e0 else greatest({low}e0, least({high}e0, {value})) end"


def b_sql(c: str) -> str:
    return f"cast(coalesce(lower(trim({c})) in ('true', '1', 'yes', 'y'), false) as int)"


def t_sql(c: str) -> str:
    return (
        f"case when regexp_full_match(trim({c}), '\\d{{4}}-\\d{{2}}-\\d{{2}}.*')"
        f" then try_cast(trim({c}) as timestamp) end"
    )


def rules_sql(c: str, rules: list[tuple[int, tuple[str, ...]]]) -> str:
    arms = " ".join(
        "when " + " or ".join(f"contains(lower(coalesce({c}, '')), '{w}')" for w in words) + f" then {code}"
        for code, words in rules
    )
    return f"(case {arms} else 0 end)"


def base_sql(s: str) -> str:
    return f"case {s} when 2 then 0.25e0 when 3 then 0.55e0 when 4 then 0.85e0 else 0e0 end"


def adjust_sql(s: str, delay: str = "null", length: str = "null") -> list[str]:
    return [
        f"case when {delay} > 0 then least({delay} / 60e0 * 0.01e0, 0.10e0) else 0e0 end",
        f"case when {length} > 0 then least({length} / 100e0 * 0.005e0, 0.08e0) else 0e0 end",
        "case when is_night = 1 then 0.03e0 else 0e0 end",
        "case when is_weekend = 1 then 0.02e0 else 0e0 end",
        "case when road_type_code = 1 then 0.03e0 else 0e0 end",
        "case when weather_code in (1, 2, 4) then 0.03e0 else 0e0 end",
        f"case when road_type_code in (3, 4, 6) and coalesce({s}, 0) <= 2 then -0.02e0 else 0e0 end",
    ]


def round_sql(c: str, digits: int) -> str:
    """Half-up rounding of the printed number, as Spark rounds; DuckDB's own works on the scaled double."""
    return f"cast(round(cast(cast({c} as varchar) as decimal(38, 20)), {digits}) as double)"


def write_risk_sql(s: str, delay: str = "null", length: str = "null") -> str:
    level = f"greatest(1, least(4, {s}))"
    extra = " + ".join(adjust_sql(level, delay, length))
    total = f"least(1e0, greatest(0e0, {base_sql(level)} + ({extra})))"
    return f"case when {s} is not null then {round_sql(total, 4)} end"


def read_risk_sql(stored: str, s: str, delay: str = "null", length: str = "null") -> str:
    total = " + ".join([base_sql(s), *adjust_sql(s, delay, length)])
    return (
        f"case when {stored} between 0e0 and 1e0 then {stored}"
        f" when {s} between 1 and 4 then least(1e0, greatest(0e0, {total})) end"
    )


WEATHER_RULES = [
    (4, ("thunder", "storm")), (2, ("snow", "ice", "sleet")), (1, ("rain", "drizzle", "shower")),
    (3, ("fog", "haze", "mist")), (5, ("cloud", "overcast")), (6, ("wind",)),
]
ROAD_RULES = [
    (1, ("interstate", "i-", "freeway", "fwy", "highway", "hwy")), (2, ("route", "us-", "sr-")),
    (3, ("street", " st", "st.")), (4, ("avenue", " ave", "ave.")), (5, ("boulevard", " blvd", "blvd.")),
    (6, ("drive", " dr", "dr.")), (7, ("road", " rd", "rd.")),
]

_FEATURE_TAIL = f"""
  cast(extract(hour from t) as int) as hour, cast(extract(dow from t) + 1 as int) as day_of_week,
  cast(extract(dow from t) in (0, 6) as int) as is_weekend,
  cast(extract(hour from t) between 7 and 9 or extract(hour from t) between 16 and 18 as int) as is_rush_hour
"""

SQL = {
    "raw_replay": RAW_REPLAY,
    "raw_parsed": f"""
select *, {t_sql('Start_Time')} as t, {f_sql('Start_Lat')} as plat, {f_sql('Start_Lng')} as plon,
  {i_sql('Severity')} as sev
from raw_replay""",
    "features": f"""
select ID as event_id, cast(extract(year from t) as int) as event_year, t as event_time, sev as true_severity,
  plat as lat, plon as lon, {_FEATURE_TAIL},
  {rules_sql('Weather_Condition', WEATHER_RULES)} as weather_code,
  {clip_sql('Temperature_F', 50, -40, 130)} as temperature_f,
  {clip_sql('Humidity_pct', 50, 0, 100)} as humidity,
  {clip_sql('Wind_Speed_mph', 0, 0, 100)} as wind_speed_mph,
  {clip_sql('Visibility_mi', 10, 0, 10)} as visibility_mi,
  {rules_sql('Street', ROAD_RULES)} as road_type_code,
  {b_sql('Junction')} as is_junction, {b_sql('Traffic_Signal')} as has_traffic_signal,
  {b_sql('Crossing')} as is_crossing, {b_sql('Roundabout')} as is_roundabout, {b_sql('Stop')} as is_stop,
  {b_sql('Station')} as is_station, {b_sql('Railway')} as is_railway,
  cast(coalesce(lower(trim(Sunrise_Sunset)) = 'night', false) as int) as is_night,
  predicted_severity, inference_latency_ms, cast(substr(ID, 3) as bigint) as k
from raw_parsed
where t is not null and plat between -90 and 90 and plon between -180 and 180 and not isnan(plat)
  and not isnan(plon) and sev between 1 and 4""",
    # Every 7th stored score is a sentinel and every 11th is missing, so that the read path repairs them.
    "replay": f"""
select f.* exclude (k),
  case when k % 7 = 0 then -1e0 when k % 11 = 0 then null
       else {write_risk_sql('coalesce(predicted_severity, true_severity)')} end as risk_score,
  case when k % 23 = 0 then null when predicted_severity is null then 'failed' else 'ok' end as model_status,
  event_time + to_seconds(k % 40) as ingestion_time,
  event_time + to_seconds(k % 40 + k % 17) as processed_time,
  cast(k % 17 as double) * 1000 as end_to_end_latency_ms,
  k
from features f""",
    "live_base": LIVE_BASE,
    "hourly_weather": HOURLY_WEATHER,
    "live_weather": """
select b.*, date_trunc('hour', b.event_time) as h,
  w.slot, w.weather_code as wx_code, w.temperature_f as wx_t, w.humidity as wx_h, w.wind_speed_mph as wx_w
from live_base b left join hourly_weather w
  on round(b.latitude, 2) = w.cell_lat and round(b.longitude, 2) = w.cell_lon
 and cast(date_trunc('hour', b.event_time) as date) = w.obs_date
qualify row_number() over (partition by b.event_id
  order by abs(epoch_us(w.slot) - epoch_us(date_trunc('hour', b.event_time))), w.slot) = 1""",
    "live_features": f"""
select event_id, incident_id, seq, event_time, latitude as lat, longitude as lon,
  greatest(case when delay_magnitude >= 4 then 4 when delay_magnitude in (2, 3) then delay_magnitude else 1 end,
    case icon_category when 8 then 4 when 1 then 3 when 9 then 2 else 1 end) as severity,
  icon_category, delay_magnitude, delay_seconds, length_meters,
  case when slot is null then 0 when wx_code in (95, 96, 99) then 4
       when wx_code in (71, 73, 75, 77, 85, 86) then 2
       when wx_code in (51, 53, 55, 56, 57, 61, 63, 65, 66, 67, 80, 81, 82) then 1
       when wx_code in (45, 48) then 3 when wx_code in (1, 2, 3) then 5 else 0 end as weather_code,
  greatest(-40e0, least(130e0, coalesce(wx_t, 50e0))) as temperature_f,
  greatest(0e0, least(100e0, coalesce(cast(wx_h as double), 50e0))) as humidity,
  greatest(0e0, least(100e0, coalesce(wx_w, 0e0))) as wind_speed_mph,
  10e0 as visibility_mi,
  {rules_sql("case when from_road <> '' then from_road else to_road end", ROAD_RULES)} as road_type_code,
  {_FEATURE_TAIL.replace('from t)', 'from event_time)')},
  0 as is_junction, 0 as has_traffic_signal, 0 as is_crossing, 0 as is_roundabout, 0 as is_stop,
  0 as is_station, 0 as is_railway,
  cast(extract(hour from event_time) >= 22 or extract(hour from event_time) < 6 as int) as is_night,
  from_road, to_road
from live_weather""",
    # Every 9th stored score is a sentinel, so that the read path repairs it.
    "live": f"""
select *, case when seq % 9 = 0 then -1e0
    else {write_risk_sql('severity', 'delay_seconds', 'length_meters')} end as risk_score,
  case when seq % 29 = 0 then null else 'rule_based' end as model_status,
  event_time + to_seconds(seq % 30) as ingestion_time,
  event_time + to_seconds(seq % 30 + seq % 13) as processed_time,
  cast(seq % 13 as double) * 1000 as end_to_end_latency_ms
from live_features""",
    "all_points": f"""
select event_id, lat, lon,
  {read_risk_sql('risk_score', 'coalesce(predicted_severity, true_severity)')} as risk_score,
  cast(predicted_severity as int) as predicted_severity, true_severity, event_time, model_status,
  'replay' as data_source, 'circle' as marker_shape, hour, temperature_f, humidity, wind_speed_mph,
  coalesce(true_severity >= 3 or predicted_severity >= 3, false) as is_severe
from replay
union all
select event_id, lat, lon, {read_risk_sql('risk_score', 'severity', 'delay_seconds', 'length_meters')},
  severity, severity, event_time, model_status, 'live', 'triangle', hour, temperature_f, humidity,
  wind_speed_mph, severity >= 3
from live""",
}
_NEEDS = {
    "raw_replay": [], "raw_parsed": ["raw_replay"], "features": ["raw_parsed"], "replay": ["features"],
    "live_base": [], "hourly_weather": [], "live_weather": ["live_base", "hourly_weather"],
    "live_features": ["live_weather"], "live": ["live_features"], "all_points": ["replay", "live"],
}


def with_views(names: list[str], query: str) -> str:
    """Oracle query preceded by the views it needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS[name]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    body = ",\n".join(f"{n} as ({SQL[n].strip()})" for n in ordered)
    query = query.strip()
    if query.lower().startswith("with "):
        return f"with {body},\n{query[5:]}"
    return f"with {body}\n{query}"


# Spark side --------------------------------------------------------------------------------------


def near(c: str, digits: int = 6):
    """Rounded average. The small shift sends exact ties the same way whatever the summation order."""
    return F.round(F.col(c) + 1e-9, digits)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_replay_of(orders: DataFrame) -> DataFrame:
    return orders.sparkSession.sql(RAW_REPLAY.replace("from orders", "from {orders}"), orders=orders)


def live_base_of(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(LIVE_BASE.replace("from events", "from {events}"), events=events)


def dealt(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The columns that the views need of a given table, stored in as many files as there are tasks.

    They are stored, not only shuffled: a filter moves below a shuffle, so the rows would be parsed before it as well.
    """
    return stored(spark, sf_dir, f"dealt-{name}", lambda: spread(_table(spark, sf_dir, name), VIEWED[name]))


def raw_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_replay_of(dealt(spark, sf_dir, "orders"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(raw_replay(spark, sf_dir))


def replay_of(raw: DataFrame) -> DataFrame:
    """Serving rows of the replay source, with some stored scores spoiled."""
    df = build_features(raw, keep=["predicted_severity", "inference_latency_ms"])
    k = F.substr(F.col("event_id"), F.lit(3)).cast("bigint")
    seconds = lambda c: F.make_dt_interval(secs=c.cast("decimal(18,6)"))
    risk, status = score_with_fallback()
    scored = df.withColumns(
        {
            "predicted_severity": F.col("predicted_severity").cast("int"),
            "risk_score": F.when(k % 7 == 0, F.lit(-1.0)).when(k % 11 == 0, F.lit(None).cast("double"))
            .otherwise(risk),
            "model_status": F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(status),
            "ingestion_time": F.col("event_time") + seconds(k % 40),
            "processed_time": F.col("event_time") + seconds(k % 40 + k % 17),
            "end_to_end_latency_ms": (k % 17).cast("double") * 1000,
        }
    )
    return scored.select(*REPLAY_COLUMNS)


#: Columns of the given tables that the views are made of.
VIEWED = {
    "orders": ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value"],
}
_TABLES: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """A serving table as it exists in use: written once per session, then read like any table."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        path = f"{shared_folder(spark, name)}/table"
        with tuned(spark):
            make().write.parquet(path)
        _TABLES[key] = path
    return spark.read.parquet(_TABLES[key])


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows as a stored table, as training and scenarios find them."""
    return stored(spark, sf_dir, "features", lambda: features(spark, sf_dir))


def replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "replay", lambda: replay_of(raw_replay(spark, sf_dir)))


def live_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_base_of(dealt(spark, sf_dir, "events"))


def hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = HOURLY_WEATHER.replace("from events", "from {events}")
    return spark.sql(text, events=dealt(spark, sf_dir, "events")).withColumn(
        "slot", F.col("slot").cast("timestamp_ntz")
    )


def live_messages(base: DataFrame) -> DataFrame:
    """Live rows in the shape of normalized incident messages."""
    return base.withColumn("timestamp", clean.iso_text(F.col("event_time"))).withColumn("source", F.lit("live"))


def live_of(base: DataFrame, weather: DataFrame) -> DataFrame:
    """Serving rows of the live source, with some stored scores spoiled."""
    raw = enrich_live(live_messages(base).drop("event_time"), weather)
    kept = [
        "incident_id", "seq", "icon_category", "delay_magnitude", "delay_seconds", "length_meters",
        "from_road", "to_road",
    ]
    df = build_features(raw, keep=kept)
    seconds = lambda c: F.make_dt_interval(secs=c.cast("decimal(18,6)"))
    seq = F.col("seq")
    risk = context_risk(F.col("true_severity"), F.col("delay_seconds"), F.col("length_meters"))
    none = F.lit(None).cast("string")
    scored = df.withColumns(
        {
            "severity": F.col("true_severity"),
            "risk_score": F.when(seq % 9 == 0, F.lit(-1.0)).otherwise(risk),
            "model_status": F.when(seq % 29 == 0, none).otherwise(F.lit("rule_based")),
            "ingestion_time": F.col("event_time") + seconds(seq % 30),
            "processed_time": F.col("event_time") + seconds(seq % 30 + seq % 13),
            "end_to_end_latency_ms": (seq % 13).cast("double") * 1000,
            "state_or_region": none, "city": none, "geometry_wkt": none,
        }
    )
    return scored.select(*LIVE_COLUMNS)


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    make = lambda: live_of(live_base(spark, sf_dir), hourly_weather(spark, sf_dir))
    return stored(spark, sf_dir, "live", make)


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(replay=replay(spark, sf_dir), live=live(spark, sf_dir))
