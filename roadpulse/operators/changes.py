"""Live incident payloads: normalization, state signatures, change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..schemas import STATE_FIELDS
from .joins import join_groups


def parse_regions(c: Column) -> Column:
    """Array of struct(state, city, bbox) from ``state:city:bbox;...``; incomplete parts are dropped."""
    parts = F.transform(F.split(c, ";"), lambda item: F.transform(F.split(item, ":", 3), lambda p: F.trim(p)))
    complete = F.filter(parts, lambda p: (F.size(p) == 3) & ~F.exists(p, lambda x: x == ""))
    return F.transform(
        complete,
        lambda p: F.struct(p[0].alias("state_or_region"), p[1].alias("city"), p[2].alias("bbox")),
    )


def region_table(df: DataFrame, column: str) -> DataFrame:
    """One row per region of a region text."""
    return df.select(F.explode(parse_regions(F.col(column))).alias("r")).select("r.*")


def normalize_incident(df: DataFrame, now=None, id_prefix: str = "live-", source: str = "live") -> DataFrame:
    """Payload incidents (column ``incident``, with state_or_region and city) to flat live messages.

    An incident without id or position is left out. The first event of an incident describes it; its
    time is the start time, else the last report, else ``now``.
    """
    stamp = F.lit(now).cast("timestamp_ntz") if now is not None else F.localtimestamp()
    now_text = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    p = lambda name: F.col(f"incident.properties.`{name}`")
    coordinates, kind = F.col("incident.geometry.coordinates"), F.col("incident.geometry.type")
    located = df.select("*", geo.first_coordinate(coordinates).alias("_at")).where(
        (F.coalesce(p("id"), F.lit("")) != "") & F.col("_at.lat").isNotNull()
    )
    time = F.coalesce(F.nullif(p("startTime"), F.lit("")), F.nullif(p("lastReportTime"), F.lit("")), now_text)
    event = F.get(p("events"), 0)
    event_id = F.concat(F.lit(id_prefix), p("id"))
    return located.select(
        event_id.alias("event_id"), event_id.alias("ID"), F.lit(source).alias("source"),
        p("id").alias("incident_id"), p("id").alias("flow_segment_id"),
        F.col("_at.lat").alias("latitude"), F.col("_at.lon").alias("longitude"), F.lit(0.0).alias("speed"),
        time.alias("timestamp"), time.alias("event_timestamp"), "state_or_region", "city",
        p("iconCategory").alias("icon_category"), p("magnitudeOfDelay").alias("delay_magnitude"),
        p("delay").alias("delay_seconds"), p("length").alias("length_meters"),
        geo.to_wkt(coordinates, kind).alias("geometry_wkt"),
        event["description"].alias("incident_description"), event["code"].alias("incident_code"),
        p("from").alias("from_road"), p("to").alias("to_road"),
        F.coalesce(p("roadNumbers"), F.array().cast("array<string>")).alias("road_numbers"),
        p("timeValidity").alias("time_validity"),
        p("probabilityOfOccurrence").alias("probability_of_occurrence"),
        p("numberOfReports").alias("number_of_reports"), p("lastReportTime").alias("last_report_time"),
        now_text.alias("ingestion_time"), now_text.alias("_ingested_at_utc"),
        F.to_json("incident").alias("raw_payload"),
    )


def state_signature(df: DataFrame, fields: list[str] | None = None) -> Column:
    """Hash of the fields that make up an incident's state. Fields a frame lacks count as null."""
    have = set(df.columns)
    names = sorted(fields or STATE_FIELDS)
    state = F.struct(*[(F.col(n) if n in have else F.lit(None).cast("string")).alias(n) for n in names])
    return F.sha2(F.to_json(state, {"ignoreNullFields": "false"}), 256)


def change_status(
    df: DataFrame, key: str, time: str, seq: str, fields: list[str] | None = None, chunk: str = "hour"
) -> DataFrame:
    """Rows with ``change_status``: new, update or unchanged against the previous state of their key.

    The history of a key is cut into time chunks, so a key with very many states is spread over
    tasks. Inside a chunk the previous state is a lag; the first row of a chunk takes the last state
    of the key's previous chunk, from a table with one row per key and chunk. Rows without time form the
    first chunk of their key, and rows without key are one key: no row is lost.
    """
    rows = df.withColumns(
        {"_sig": state_signature(df, fields), "_chunk": F.date_trunc(chunk, F.col(time)).cast("timestamp_ntz")}
    )
    order = F.struct(F.col(time), F.col(seq))
    ends = rows.groupBy(key, "_chunk").agg(F.max_by("_sig", order).alias("_last"))
    history = Window.partitionBy(key).orderBy("_chunk")
    carried = ends.select(key, "_chunk", F.lag("_last").over(history).alias("_carried"))
    inside = Window.partitionBy(key, "_chunk").orderBy(time, seq)
    marked = join_groups(rows.withColumn("_previous", F.lag("_sig").over(inside)), carried, [key, "_chunk"])
    previous = F.coalesce("_previous", "_carried")
    status = (
        F.when(previous.isNull(), F.lit("new")).when(previous == F.col("_sig"), F.lit("unchanged"))
        .otherwise(F.lit("update"))
    )
    return marked.withColumn("change_status", status).select(*df.columns, "change_status")


def published_changes(df: DataFrame) -> DataFrame:
    """Rows that are new or changed."""
    return df.where(F.col("change_status") != "unchanged")


def change_summary(df: DataFrame) -> DataFrame:
    """Rows fetched, and how many were new, updated or unchanged."""
    is_ = lambda s: F.count_if(F.col("change_status") == s)
    return df.agg(
        F.count("*").alias("fetched"), is_("new").alias("published_new"),
        is_("update").alias("published_updates"), is_("unchanged").alias("skipped_unchanged"),
    )
