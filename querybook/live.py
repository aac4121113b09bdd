"""Live incidents: payloads, weather, change detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions import clean, geo
from roadpulse.operators import changes as ch
from roadpulse.operators.features import build_features, enrich_live, stream_features
from roadpulse.operators.weather import explode_hourly, join_weather, lookup_work_list
from roadpulse.schemas import FEATURE_COLUMNS, RAW_COLUMNS
from roadpulse.session import shared_folder
from roadpulse.sources import files

from . import views as v
from .registry import Registry

query = Registry()


@query(
    "weather_asof",
    v.with_views(
        ["live_weather"],
        """
select event_id, slot as wx_slot, wx_code as wx_weather_code, wx_t as wx_temperature_f, wx_h as wx_humidity, wx_w as wx_wind_speed_mph
from live_weather""",
    ),
)
def weather_asof(spark, sf_dir):
    events = v.live_base(spark, sf_dir).select("event_id", "latitude", "longitude", "event_time")
    joined = join_weather(events, v.hourly_weather(spark, sf_dir), "latitude", "longitude", "event_time")
    return joined.drop("latitude", "longitude", "event_time")


@query(
    "weather_work_list",
    """
select distinct round(40.4e0 + (user_id % 50) / 1e2, 2) as cell_lat, round(-74.2e0 + (user_id % 40) / 1e2, 2) as cell_lon,
  date_trunc('hour', ts) as slot from events""",
)
def weather_work_list(spark, sf_dir):
    return lookup_work_list(v.live_base(spark, sf_dir), "latitude", "longitude", "event_time")


@query(
    "explode_hourly",
    v.with_views(
        ["hourly_weather"],
        "select cell_lat, cell_lon, obs_date, slot, weather_code, temperature_f, cast(humidity as double) as humidity, wind_speed_mph"
        " from hourly_weather",
    ),
)
def hourly_rows(spark, sf_dir):
    """Parallel arrays as the weather feed sends them, back to rows."""
    rows = v.hourly_weather(spark, sf_dir)
    ordered = F.array_sort(
        F.collect_list(F.struct("slot", "weather_code", "temperature_f", F.col("humidity").cast("double").alias("humidity"), "wind_speed_mph"))
    )
    packed = rows.groupBy("cell_lat", "cell_lon", "obs_date").agg(ordered.alias("a"))
    part = lambda name: F.transform("a", lambda x: x[name])
    documents = packed.select(
        "cell_lat", "cell_lon",
        F.struct(
            F.transform("a", lambda x: F.date_format(x["slot"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
            part("temperature_f").alias("temperature_2m"), part("humidity").alias("relative_humidity_2m"),
            part("weather_code").alias("weather_code"), part("wind_speed_mph").alias("wind_speed_10m"),
        ).alias("hourly"),
    )
    return explode_hourly(documents)


@query(
    "live_features",
    v.with_views(
        ["live_features"],
        f"select {', '.join('severity as true_severity' if c == 'true_severity' else 'cast(extract(year from event_time) as int) as event_year' if c == 'event_year' else c for c in FEATURE_COLUMNS)} from live_features",
    ),
)
def live_features(spark, sf_dir):
    messages = v.live_messages(v.live_base(spark, sf_dir)).drop("event_time")
    return build_features(enrich_live(messages, v.hourly_weather(spark, sf_dir)))


@query(
    "enrich_stream",
    v.with_views(
        ["features", "live_features"],
        """
select 'live' as source, count(*) as n, cast(sum(true_severity) as bigint) as severity, cast(sum(weather_code) as bigint) as weather
from (select severity as true_severity, 0 as weather_code from live_features)
union all select '', count(*), cast(sum(true_severity) as bigint), cast(sum(weather_code) as bigint) from features""",
    ),
)
def enrich_mixed(spark, sf_dir):
    """Replay and live messages in one frame, routed by their source."""
    live = v.live_messages(v.live_base(spark, sf_dir)).drop("event_time", "seq", "event_type")
    live = live.select(*[F.col(c).cast("string").alias(c) for c in live.columns])
    raw = v.raw_replay(spark, sf_dir).select(*RAW_COLUMNS).withColumn("source", F.lit(""))
    mixed = raw.unionByName(live, allowMissingColumns=True)
    rows = stream_features(mixed, keep=["source"])
    return rows.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("true_severity").alias("severity"), F.sum("weather_code").alias("weather")
    )


STATE = "concat_ws('|', delay_magnitude % 2, icon_category // 6, from_road)"
CHANGES = f"""
changes as (select *, case when previous is null then 'new' when previous = state then 'unchanged' else 'update' end as change_status
  from (select *, {STATE} as state,
    lag({STATE}) over (partition by incident_id order by event_time, seq) as previous from live_base))"""


def states(base):
    """Live rows with a coarse state, so that repeats happen."""
    return base.select(
        "event_id", "incident_id", "seq", "event_time", (F.col("delay_magnitude") % 2).alias("delay_magnitude"),
        F.floor(F.col("icon_category") / 6).alias("icon_category"), "from_road",
    )


@query("change_status", v.with_views(["live_base"], f"with {CHANGES} select event_id, change_status from changes"))
def change_status(spark, sf_dir):
    marked = ch.change_status(states(v.live_base(spark, sf_dir)), "incident_id", "event_time", "seq")
    return marked.select("event_id", "change_status")


@query(
    "change_summary",
    v.with_views(
        ["live_base"],
        f"""
with {CHANGES} select count(*) as fetched, count(*) filter (where change_status = 'new') as published_new,
  count(*) filter (where change_status = 'update') as published_updates,
  count(*) filter (where change_status = 'unchanged') as skipped_unchanged from changes""",
    ),
)
def change_summary(spark, sf_dir):
    return ch.change_summary(
        ch.change_status(states(v.live_base(spark, sf_dir)), "incident_id", "event_time", "seq")
    )


def payloads(spark, sf_dir, *also):
    """Incidents made of the events, one each, as they would be parsed."""
    n = F.col("event_id")
    lon, lat = (F.lit(-74.2) + n % 40 / 100).cast("string"), (F.lit(40.4) + n % 50 / 100).cast("string")
    point = F.concat(F.lit("["), lon, F.lit(","), lat, F.lit("]"))
    line = F.concat(F.lit("["), point, F.lit(",["), lat, F.lit(","), lon, F.lit("]]"))
    events = F.when(
        n % 2 == 0,
        F.array(F.struct(F.col("event_type").alias("description"), (n % 100).cast("int").alias("code"), F.lit(1).alias("iconCategory"))),
    )
    properties = F.struct(
        F.when(n % 50 != 0, n.cast("string")).alias("id"), (n % 12).cast("int").alias("iconCategory"),
        (n % 6).cast("int").alias("magnitudeOfDelay"),
        F.when(n % 3 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("startTime"),
        F.lit("Main").alias("from"), F.lit(None).cast("string").alias("to"), (n % 900).cast("double").alias("length"),
        F.col("value").alias("delay"), F.array(F.lit("I-95"), F.lit("US-1")).alias("roadNumbers"),
        F.lit("present").alias("timeValidity"), F.lit("certain").alias("probabilityOfOccurrence"),
        (n % 5).cast("int").alias("numberOfReports"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("lastReportTime"),
        events.alias("events"),
    )
    geometry = F.struct(
        F.when(n % 5 == 0, F.lit("Point")).when(n % 5 == 1, F.lit("Polygon")).otherwise(F.lit("LineString")).alias("type"),
        F.when(n % 5 == 0, point).when(n % 77 == 3, F.lit("[]")).otherwise(line).alias("coordinates"),
    )
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    return source.select(
        F.struct(properties.alias("properties"), geometry.alias("geometry")).alias("incident"),
        F.lit("US").alias("state_or_region"), F.lit("New York").alias("city"), *also,
    )


LON = "cast(-74.2e0 + event_id % 40 / 100e0 as varchar)"
LAT = "cast(40.4e0 + event_id % 50 / 100e0 as varchar)"
WKT = f"""case when event_id % 5 = 0 then 'POINT (' || {LON} || ' ' || {LAT} || ')' when event_id % 5 = 1 then ''
  else 'LINESTRING (' || {LON} || ' ' || {LAT} || ', ' || {LAT} || ' ' || {LON} || ')' end"""
USABLE = "event_id % 50 <> 0 and not (event_id % 77 = 3 and event_id % 5 <> 0)"


@query(
    "normalize_incidents",
    f"""
select 'live-' || event_id as event_id, -74.2e0 + event_id % 40 / 100e0 as longitude, 40.4e0 + event_id % 50 / 100e0 as latitude,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as timestamp, {WKT} as geometry_wkt,
  case when event_id % 2 = 0 then event_type end as incident_description, 'I-95, US-1' as roads
from events where {USABLE}""",
)
def normalize_incidents(spark, sf_dir):
    rows = ch.normalize_incident(payloads(spark, sf_dir), now="2024-05-01 00:00:00")
    return rows.select(
        "event_id", "longitude", "latitude", "timestamp", "geometry_wkt", "incident_description",
        F.array_join("road_numbers", ", ").alias("roads"),
    )


@query("to_wkt", f"select event_id, case when event_id % 77 = 3 and event_id % 5 <> 0 then '' else {WKT} end as wkt from events")
def to_wkt(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = F.col("event_id")
    lon, lat = (F.lit(-74.2) + n % 40 / 100).cast("string"), (F.lit(40.4) + n % 50 / 100).cast("string")
    point = F.concat(F.lit("["), lon, F.lit(","), lat, F.lit("]"))
    line = F.concat(F.lit("["), point, F.lit(",["), lat, F.lit(","), lon, F.lit("]]"))
    kind = F.when(n % 5 == 0, F.lit("Point")).when(n % 5 == 1, F.lit("Polygon")).otherwise(F.lit("LineString"))
    shape = F.when(n % 5 == 0, point).when(n % 77 == 3, F.lit("[]")).otherwise(line)
    return rows.select("event_id", geo.to_wkt(shape, kind).alias("wkt"))


REGIONS = "NY:New York:-74,40,-73,41; NJ : Newark:-75,40,-74,41;:nowhere:0,0,1,1;CT:Hartford:-73,41,-72,42"
DOCUMENT = "event_id // 40"


@query(
    "payload_scan",
    f"""
with e as (select *, {DOCUMENT} as doc, event_id // 40 % 3 as region, event_id // 40 % 7 = 3 as spoiled from events),
r as (select * from (values (0, 'NY', 'New York'), (1, 'NJ', 'Newark'), (2, 'CT', 'Hartford')) t(region, state_or_region, city))
select 'incident' as kind, 'live-' || event_id as event_id, state_or_region, city, 'I-95, US-1' as roads, {WKT} as geometry_wkt
from e join r using (region) where not spoiled and {USABLE}
union all select 'damaged', null, state_or_region, city, null, null from (select distinct doc, region from e where spoiled) join r using (region)""",
)
def payload_scan(spark, sf_dir):
    """Feed documents of several incidents landed by region, some cut off: incidents as flat messages, damaged documents apart."""
    made = payloads(spark, sf_dir, "event_id")
    text = F.to_json(F.struct(F.collect_list("incident").alias("incidents")))
    documents = made.groupBy(F.floor(F.col("event_id") / 40).alias("doc")).agg(text.alias("whole"))
    cut = F.when(F.col("doc") % 7 == 3, F.expr("left(whole, cast(length(whole) / 2 as int))")).otherwise(F.col("whole"))
    folder = f"{shared_folder(spark, 'payloads')}/documents"
    documents.select(cut.alias("value"), (F.col("doc") % 3).alias("region")).write.partitionBy("region").text(folder)

    listed = spark.range(1).select(F.posexplode(ch.parse_regions(F.lit(REGIONS))).alias("region", "of")).select("region", "of.state_or_region", "of.city")
    found = files.read_payload_documents(spark, folder).join(F.broadcast(listed), "region")
    flat = ch.normalize_incident(files.incidents_of(found), now="2024-05-01 00:00:00")
    incidents = flat.select(F.lit("incident").alias("kind"), "event_id", "state_or_region", "city", clean.join_array(F.col("road_numbers")).alias("roads"), "geometry_wkt")
    none = F.lit(None).cast("string")
    damaged = found.where("damaged is not null").select(F.lit("damaged"), none, "state_or_region", "city", none, none)
    return incidents.union(damaged)
