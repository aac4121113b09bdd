"""Streaming pipelines run over the given tables until drained, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.schemas import LIVE_SCHEMA, REPLAY_SCHEMA
from roadpulse.session import shared_folder
from roadpulse.sources.files import spread
from roadpulse.sources.sinks import KeyedTable
from roadpulse.sources.streams import replay_source
from roadpulse.streaming import changes as sc
from roadpulse.streaming import metrics as sm
from roadpulse.streaming import pipelines as sp
from roadpulse.streaming import running

from . import views as v
from .live import CHANGES, states
from .registry import Registry

query = Registry()
NOW = "2024-06-01 00:00:00"


def _table_stream(spark, sf_dir, name):
    """A given table as a file stream."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _messages_stream(spark, sf_dir, name):
    """The columns of a given table that the views need, as a file stream whose rows are dealt over all tasks before they become messages."""
    return spread(_table_stream(spark, sf_dir, name), v.VIEWED[name])


def _drain(query_):
    query_.awaitTermination()


@query(
    "stream_replay",
    v.with_views(
        ["features"],
        f"""
select event_id, event_year, event_time, true_severity, cast(predicted_severity as int) as predicted_severity,
  coalesce({v.write_risk_sql('predicted_severity')}, {v.write_risk_sql('true_severity')}) as risk_score,
  case when predicted_severity is null then 'failed' else 'ok' end as model_status, timestamp '{NOW}' as processed_time,
  86400000e0 * 31 as end_to_end_latency_ms from features""",
    ),
)
def stream_replay(spark, sf_dir):
    """JSON messages through the whole replay pipeline."""
    folder = shared_folder(spark, "stream-replay")
    raw = v.raw_replay_of(_messages_stream(spark, sf_dir, "orders")).withColumn("_ingested_at_utc", F.lit("2024-05-01T00:00:00+00:00"))
    messages = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    config = sp.StreamConfig(
        f"{folder}/checkpoint", f"{folder}/table", quarantine=f"{folder}/bad", now=NOW,
        spread=spark.sparkContext.defaultParallelism,
    )
    _drain(sp.start_replay(sp.replay_messages(messages, "predicted_severity string"), config))
    table = KeyedTable(spark, config.table, REPLAY_SCHEMA, sp.KEY, sp.ORDER).read()
    return table.select(
        "event_id", "event_year", "event_time", "true_severity", "predicted_severity", "risk_score", "model_status",
        "processed_time", "end_to_end_latency_ms",
    )


def _landed_messages(spark, sf_dir, folder, files=6):
    """The replay messages of the orders as JSON files, one for each micro-batch: the folder and their schema."""
    raw = v.raw_replay(spark, sf_dir).withColumn("_ingested_at_utc", F.lit("2024-05-01T00:00:00+00:00"))
    raw.repartition(files).write.json(f"{folder}/in")
    return f"{folder}/in", raw.schema


@query(
    "stream_restart",
    v.with_views(
        ["features"],
        f"""
select event_id, true_severity, coalesce({v.write_risk_sql('predicted_severity')}, {v.write_risk_sql('true_severity')}) as risk_score,
  1 as copies, 2 as restarts, 6 as batches from features""",
    ),
)
def stream_restart(spark, sf_dir):
    """The replay pipeline with two failures between a batch's write and its commit, started again from its checkpoint."""
    folder, failures = shared_folder(spark, "stream-restart"), {1, 4}
    landed, schema = _landed_messages(spark, sf_dir, folder)

    def fails_once(batch_id):
        if batch_id in failures:
            failures.remove(batch_id)
            raise RuntimeError(f"lost after the write of batch {batch_id}")

    config = sp.StreamConfig(f"{folder}/checkpoint", f"{folder}/table", now=NOW, after_write=fails_once)
    restarts = running.run_until_drained(lambda: sp.start_replay(replay_source(spark, landed, 1, schema), config))
    table = KeyedTable(spark, config.table, REPLAY_SCHEMA, sp.KEY, sp.ORDER)
    copies = table.written().groupBy("event_id").agg(F.count("*").cast("int").alias("copies"))
    rows = table.read().select("event_id", "true_severity", "risk_score").join(copies, "event_id")
    return rows.withColumns({"restarts": F.lit(restarts), "batches": F.lit(len(table.batch_numbers()))})


@query(
    "both_streams",
    v.with_views(
        ["features", "live_features"],
        """
select 'replay' as stream, (select count(*) from orders) as input_rows, (select count(*) from features) as served, 4 as batches, true as rated
union all select 'live', (select count(*) from events), (select count(*) from live_features), 1, true""",
    ),
)
def both_streams(spark, sf_dir):
    """Replay and live pipelines at the same time in one session: rows read and served by each, with the rates reported."""
    folder = shared_folder(spark, "both-streams")
    landed, schema = _landed_messages(spark, sf_dir, folder, 4)
    live = v.live_messages(v.live_base_of(_messages_stream(spark, sf_dir, "events"))).drop("event_time", "seq", "event_type")
    text = live.select(F.to_json(F.struct(*live.columns)).alias("value"))
    configs = {n: sp.StreamConfig(f"{folder}/{n}/checkpoint", f"{folder}/{n}/table", now=NOW, name=n) for n in ("replay", "live")}
    rates = running.run_together(spark, {
        "replay": lambda: sp.start_replay(replay_source(spark, landed, 1, schema), configs["replay"]),
        "live": lambda: sp.start_live(sp.live_messages(text), configs["live"], v.hourly_weather(spark, sf_dir)),
    })
    schemas = {"replay": REPLAY_SCHEMA, "live": LIVE_SCHEMA}
    served = [KeyedTable(spark, configs[n].table, schemas[n], sp.KEY, sp.ORDER).read().select(F.lit(n).alias("stream")) for n in configs]
    counts = served[0].union(served[1]).groupBy("stream").agg(F.count("*").alias("served"))
    sums = rates.groupBy("stream").agg(
        F.sum("input_rows").alias("input_rows"), F.count("*").cast("int").alias("batches"), (F.min("rows_per_second") > 0).alias("rated"))
    return sums.join(counts, "stream")


@query(
    "stream_live",
    v.with_views(
        ["live_features"],
        f"""
select event_id, incident_id, event_time, severity, {v.write_risk_sql('severity', 'delay_seconds', 'length_meters')} as risk_score,
  weather_code, temperature_f, icon_category, delay_seconds, 'rule_based' as model_status from live_features""",
    ),
)
def stream_live(spark, sf_dir):
    """Live messages through the whole live pipeline, with weather."""
    folder = shared_folder(spark, "stream-live")
    live = v.live_messages(v.live_base_of(_messages_stream(spark, sf_dir, "events"))).drop("event_time", "seq", "event_type")
    messages = live.select(F.to_json(F.struct(*live.columns)).alias("value"))
    config = sp.StreamConfig(
        f"{folder}/checkpoint", f"{folder}/table", quarantine=f"{folder}/bad", now=NOW,
        spread=spark.sparkContext.defaultParallelism,
    )
    _drain(sp.start_live(sp.live_messages(messages), config, v.hourly_weather(spark, sf_dir)))
    table = KeyedTable(spark, config.table, LIVE_SCHEMA, sp.KEY, sp.ORDER).read()
    return table.select(
        "event_id", "incident_id", "event_time", "severity", "risk_score", "weather_code", "temperature_f", "icon_category",
        "delay_seconds", "model_status",
    )


SPOILED = [  # what is wrong with every so many of the live messages, and the reason given
    (17, "latitude", "'95.5'", "coordinate_out_of_range"), (19, "longitude", "'west'", "bad_coordinate"),
    (23, "timestamp", "'yesterday'", "bad_time"), (29, "timestamp", "cast(null as string)", "bad_time"),
]


def _reason_sql() -> str:
    """The first rule that a spoiled message fails; time comes first, then the coordinates' presence, then their range."""
    order = ["bad_time", "bad_coordinate", "coordinate_out_of_range"]
    arms = sorted(SPOILED, key=lambda x: order.index(x[3]))
    return "case " + " ".join(f"when seq % {n} = 0 then '{reason}'" for n, _, _, reason in arms) + " else 'served' end"


@query(
    "live_rejects",
    v.with_views(["live_base"], f"select {_reason_sql()} as outcome, count(*) as n from live_base group by 1"),
)
def live_rejects(spark, sf_dir):
    """Live messages of which some are spoiled: every message is served, or quarantined with its reason."""
    folder = shared_folder(spark, "stream-rejects")
    base = v.live_base_of(_messages_stream(spark, sf_dir, "events"))
    live = v.live_messages(base).drop("event_time", "event_type")
    live = live.withColumns({c: F.col(c).cast("string") for c in ("latitude", "longitude", "timestamp")})
    for n, column, wrong, _ in SPOILED:
        live = live.withColumn(column, F.when(F.col("seq") % n == 0, F.expr(wrong)).otherwise(F.col(column)))
    messages = live.select(F.to_json(F.struct(*[c for c in live.columns if c != "seq"])).alias("value"))
    config = sp.StreamConfig(f"{folder}/checkpoint", f"{folder}/table", quarantine=f"{folder}/bad", now=NOW)
    _drain(sp.start_live(sp.live_messages(messages), config))
    served = KeyedTable(spark, config.table, LIVE_SCHEMA, sp.KEY, sp.ORDER).read().select(F.lit("served").alias("outcome"))
    bad = spark.read.parquet(config.quarantine).select(F.col("reject_reason").alias("outcome"))
    return served.unionByName(bad).groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    "stream_scored",
    v.with_views(["features"], "select event_id, true_severity, true as scored, 'ok' as model_status from features"),
)
def stream_scored(spark, sf_dir):
    """The replay pipeline with a stored model that scores every row."""
    from pyspark.ml.classification import DecisionTreeClassifier

    from roadpulse.operators import ml
    from roadpulse.plans.train import load_latest, save_model

    folder = shared_folder(spark, "stream-scored")
    fitted = ml.train(v.feature_table(spark, sf_dir), DecisionTreeClassifier(maxDepth=4, seed=ml.SEED))
    save_model(fitted, f"{folder}/models")
    raw = v.raw_replay_of(_messages_stream(spark, sf_dir, "orders")).drop("predicted_severity")
    messages = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    config = sp.StreamConfig(
        f"{folder}/checkpoint", f"{folder}/table", now=NOW, model=load_latest(spark, f"{folder}/models"),
        spread=spark.sparkContext.defaultParallelism,
    )
    _drain(sp.start_replay(sp.replay_messages(messages), config))
    table = KeyedTable(spark, config.table, REPLAY_SCHEMA, sp.KEY, sp.ORDER).read()
    return table.select("event_id", "true_severity", F.col("predicted_severity").between(1, 4).alias("scored"), "model_status")


@query(
    "stream_changes",
    v.with_views(
        ["live_base"], f"with {CHANGES} select event_id, change_status from changes where change_status <> 'unchanged'"
    ),
)
def stream_changes(spark, sf_dir):
    folder = shared_folder(spark, "stream-changes")
    changed = sc.detect_changes(
        states(v.live_base_of(_table_stream(spark, sf_dir, "events"))), "incident_id", "event_time", "seq"
    )
    writer = changed.writeStream.format("parquet").option("path", f"{folder}/out")
    _drain(writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    return spark.read.parquet(f"{folder}/out").select("event_id", "change_status")


@query(
    "stream_throughput",
    """
with w as (select time_bucket(interval 6 hour, ts) as window_start, count(*) as event_count, avg(value) as a, max(value) as m
  from events group by 1)
select window_start, window_start + interval 6 hour as window_end, event_count, round(event_count / 21600e0, 4) as events_per_second,
  round(a + 1e-9, 6) as avg_latency_ms, m as max_latency_ms from w
where window_start + interval 6 hour <= (select max(ts) - interval 10 minute from events)""",
)
def stream_throughput(spark, sf_dir):
    """Finished windows of a drained stream."""
    folder = shared_folder(spark, "stream-throughput")
    windows = sm.stream_throughput(
        _table_stream(spark, sf_dir, "events"), "6 hours", time="ts", latency="value"
    )
    writer = windows.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out")
    _drain(writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    return spark.read.parquet(f"{folder}/out").withColumn("avg_latency_ms", v.near("avg_latency_ms"))


@query(
    "sliding_throughput",
    """
select window_start, window_start + interval 1 day as window_end, count(*) as event_count, round(count(*) / 86400e0, 4) as events_per_second,
  round(avg(value) + 1e-9, 6) as avg_latency_ms, max(value) as max_latency_ms
from (select value, unnest([time_bucket(interval 12 hour, ts), time_bucket(interval 12 hour, ts) - interval 12 hour]) as window_start from events)
group by 1""",
)
def sliding_throughput(spark, sf_dir):
    """Sliding windows over the table."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    out = sm.stream_throughput(rows, "24 hours", "12 hours", time="ts", latency="value")
    return out.withColumn("avg_latency_ms", v.near("avg_latency_ms"))
