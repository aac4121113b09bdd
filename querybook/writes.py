"""Keyed writes, splits, shards, backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import keyed
from roadpulse.schemas import LIVE_SCHEMA, REPLAY_SCHEMA
from roadpulse.session import shared_folder
from roadpulse.sources import sinks
from roadpulse.sources.streams import shard as shard_by_key
from roadpulse.sources.streams import shard_by_row

from . import views as v
from .registry import Registry

query = Registry()

LATEST = """
select incident_id as event_id, event_time, severity, risk_score, delay_seconds from live
{where} qualify row_number() over (partition by incident_id order by event_time desc, seq desc) = 1"""


def _states(spark, sf_dir):
    """Live rows under their incident id, which repeats."""
    rows = v.live(spark, sf_dir).withColumn("seq", F.substr(F.col("event_id"), F.lit(6)).cast("bigint"))
    return rows.withColumn("event_id", F.col("incident_id"))


@query("latest_per_key", v.with_views(["live"], LATEST.format(where="")))
def latest_per_key(spark, sf_dir):
    latest = keyed.latest_per_key(_states(spark, sf_dir), "event_id", ["event_time", "seq"])
    return latest.select("event_id", "event_time", "severity", "risk_score", "delay_seconds")


UPSERT = v.with_views(
    ["live"],
    """
with first_ as (select * from live where seq % 3 <> 0
    qualify row_number() over (partition by incident_id order by event_time desc, seq desc) = 1),
second_ as (select * from live where seq % 3 = 0
    qualify row_number() over (partition by incident_id order by event_time desc, seq desc) = 1)
select coalesce(s.incident_id, f.incident_id) as event_id, case when s.incident_id is null then f.event_time else s.event_time end as event_time,
  case when s.incident_id is null then f.severity else s.severity end as severity,
  case when s.incident_id is null then timestamp '2024-02-01' else timestamp '2024-02-02' end as updated_at,
  case when f.incident_id is null then timestamp '2024-02-02' else timestamp '2024-02-01' end as created_at
from first_ f full join second_ s on f.incident_id = s.incident_id""",
)
COLUMNS = ["event_id", "event_time", "severity", "updated_at", "created_at"]


def _two_batches(spark, sf_dir):
    rows = _states(spark, sf_dir)
    seq = F.col("seq")
    return rows.where(seq % 3 != 0), rows.where(seq % 3 == 0)


@query("upsert_latest", UPSERT)
def upsert_latest(spark, sf_dir):
    """Two batches folded into an empty table as frames."""
    one, two = _two_batches(spark, sf_dir)
    order = ["event_time", "seq"]
    empty = spark.createDataFrame([], LIVE_SCHEMA)
    table = keyed.upsert(empty, one, "event_id", order, now="2024-02-01 00:00:00")
    return keyed.upsert(table, two, "event_id", order, now="2024-02-02 00:00:00").select(*COLUMNS)


@query("upsert_table", UPSERT)
def upsert_table(spark, sf_dir):
    """The same two batches through a stored table, with a compaction and a repeated batch."""
    one, two = _two_batches(spark, sf_dir)
    table = sinks.KeyedTable(
        spark, shared_folder(spark, "upsert"), LIVE_SCHEMA, "event_id", ["event_time", "seq"]
    )
    table.upsert(one, 1, now="2024-02-01 00:00:00")
    table.compact()
    for _ in range(2):
        table.upsert(two, 2, now="2024-02-02 00:00:00")
    return table.read().select(*COLUMNS)


@query(
    "update_from",
    v.with_views(
        ["replay"],
        """
select event_id, case when k % 4 = 1 then true_severity else cast(predicted_severity as int) end as predicted_severity,
  case when k % 4 = 1 then 0.5e0 else risk_score end as risk_score,
  case when k % 4 = 1 then 'ok' else model_status end as model_status, hour from replay""",
    ),
)
def update_from(spark, sf_dir):
    table = v.replay(spark, sf_dir).select(
        "event_id", "predicted_severity", "risk_score", "model_status", "hour", "true_severity"
    )
    k = F.substr(F.col("event_id"), F.lit(3)).cast("bigint")
    updates = table.where(k % 4 == 1).select(
        "event_id", F.col("true_severity").alias("predicted_severity"), F.lit(0.5).alias("risk_score"),
        F.lit("ok").alias("model_status"),
    )
    columns = ["predicted_severity", "risk_score", "model_status"]
    return keyed.update_from(table, updates, "event_id", columns).drop("true_severity")


@query(
    "align_schema",
    v.with_views(
        ["features"],
        "select event_id, cast(true_severity as int) as true_severity, cast(null as double) as risk_score from features",
    ),
)
def align_schema(spark, sf_dir):
    aligned = keyed.align_schema(v.features(spark, sf_dir), REPLAY_SCHEMA)
    return aligned.select("event_id", "true_severity", "risk_score")


@query(
    "split_by_year",
    v.with_views(
        ["raw_parsed"],
        f"""
select ID, cast(extract(year from t) as int) as event_year, case when t is null then 'invalid'
  when extract(year from t) < {v.SPLIT_YEAR} then 'train' else 'pipeline' end as side from raw_parsed""",
    ),
)
def split_by_year(spark, sf_dir):
    return sinks.split_by_year(v.raw_replay(spark, sf_dir), v.SPLIT_YEAR).select("ID", "event_year", "side")


@query("shard", "select o_orderkey as row_index, o_custkey from orders where o_orderkey >= 100 and o_orderkey % 3 = 2")
def shard(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("row_index"), "o_custkey")
    return shard_by_row(rows, 3, 2, "row_index", start=100)


@query(
    "shards_cover",
    v.with_views(["raw_replay"], "select count(*) as rows, count(distinct ID) as ids from raw_replay"),
)
def shards_cover(spark, sf_dir):
    """All hash shards together give every row once."""
    raw = v.raw_replay(spark, sf_dir).select("ID")
    parts = [shard_by_key(raw, 3, i) for i in range(3)]
    return parts[0].union(parts[1]).union(parts[2]).agg(
        F.count("*").alias("rows"), F.count_distinct("ID").alias("ids")
    )
