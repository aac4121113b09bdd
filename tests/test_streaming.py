"""Streams against the batch operators, over several micro-batches and a restart."""

import pytest
from pyspark.sql import functions as F

from querybook import views as v
from querybook.live import states
from roadpulse.operators import changes as ch
from roadpulse.operators.features import build_features, features_or_reason
from roadpulse.plans.jobs import score_replay
from roadpulse.schemas import LIVE_SCHEMA, RAW_COLUMNS, REPLAY_COLUMNS, REPLAY_SCHEMA
from roadpulse.sources.files import read_silver
from roadpulse.sources.sinks import KeyedTable
from roadpulse.sources.streams import replay_source, text_source
from roadpulse.streaming import changes as sc
from roadpulse.streaming import metrics as sm
from roadpulse.streaming import pipelines as sp

NOW = "2024-06-01 00:00:00"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def config(path, **more):
    return sp.StreamConfig(
        str(path / "checkpoint"), str(path / "table"), silver=str(path / "silver"), quarantine=str(path / "bad"), now=NOW, **more
    )


def some_raw(spark):
    """Raw rows of a few days, bad ones included."""
    rows = v.raw_replay(spark, "/root/testdata/sf0.01").select(*RAW_COLUMNS)
    return rows.where(F.col("Start_Time").rlike("^(1996-03-0|not|$)"))


def test_replay_equals_batch_over_batches_and_restart(spark, sf, tmp_path):
    raw = some_raw(spark)
    key = F.pmod(F.xxhash64("ID"), F.lit(6))
    parts = [raw.where(key == i).coalesce(1) for i in range(6)]
    source, conf = str(tmp_path / "in"), config(tmp_path)
    for part in parts[:3]:
        part.write.mode("append").json(source)
    sp.start_replay(replay_source(spark, source, 1), conf).awaitTermination()
    halfway = KeyedTable(spark, conf.table, REPLAY_SCHEMA, sp.KEY, sp.ORDER).read().count()
    for part in parts[3:]:
        part.write.mode("append").json(source)
    query = sp.start_replay(replay_source(spark, source, 1), conf)
    query.awaitTermination()
    table = KeyedTable(spark, conf.table, REPLAY_SCHEMA, sp.KEY, sp.ORDER)
    want = score_replay(build_features(raw), now=NOW)
    compared = [c for c in REPLAY_COLUMNS if c in want.columns]
    assert 0 < halfway < want.count() and len(table._numbers("batches")) == 6
    assert rows(table.read().select(*compared)) == rows(want.select(*compared))
    assert read_silver(spark, conf.silver).count() == want.count()
    bad = spark.read.parquet(conf.quarantine)
    assert bad.count() == raw.count() - want.count()
    assert bad.where("get_json_object(message, '$.ID') is null").count() == 0


def test_running_a_batch_again_changes_nothing(spark, sf, tmp_path):
    raw, conf = some_raw(spark), config(tmp_path)
    table = KeyedTable(spark, conf.table, REPLAY_SCHEMA, sp.KEY, sp.ORDER)
    sp.replay_batch(raw, 0, conf)
    once = rows(table.read()), read_silver(spark, conf.silver).count()
    sp.replay_batch(raw, 0, conf)
    assert (rows(table.read()), read_silver(spark, conf.silver).count()) == once


def test_message_names_and_damaged_messages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = '{"ID": "A", "Severity": "2", "Start_Time": "2020-01-01 01:00:00", "Start_Lat": "1", "Start_Lng": "2", "Temperature(F)": "71", "_ingested_at_utc": "2024-05-31T23:59:00+00:00"}'
    (tmp_path / "in" / "a.txt").write_text(good + "\n{broken\n")
    conf = config(tmp_path)
    sp.start_replay(sp.replay_messages(text_source(spark, str(tmp_path / "in"))), conf).awaitTermination()
    row = KeyedTable(spark, conf.table, REPLAY_SCHEMA, sp.KEY, sp.ORDER).read().head()
    assert (row["event_id"], row["temperature_f"], row["end_to_end_latency_ms"]) == ("A", 71.0, 60_000.0)
    assert (row["model_status"], row["risk_score"]) == ("failed", 0.25)
    assert spark.read.parquet(conf.quarantine).head()["reject_reason"] == "bad_time"


def test_live_equals_batch(spark, sf, tmp_path):
    base, weather = v.live_base(spark, sf), v.hourly_weather(spark, sf)
    messages = v.live_messages(base).drop("event_time", "seq", "event_type").withColumn("_ingested_at_utc", F.lit("2024-05-31T23:59:59Z"))
    text = messages.select(F.to_json(F.struct(*messages.columns)).alias("value"))
    text.repartition(3).write.text(str(tmp_path / "in"))
    conf = config(tmp_path)
    stream = sp.live_messages(text_source(spark, str(tmp_path / "in"), 1))
    sp.start_live(stream, conf, weather).awaitTermination()
    got = KeyedTable(spark, conf.table, LIVE_SCHEMA, sp.KEY, sp.ORDER).read()
    want = sp.live_rows(messages, weather, NOW)
    columns = ["event_id", "incident_id", "severity", "risk_score", "weather_code", "delay_seconds", "end_to_end_latency_ms"]
    assert rows(got.select(*columns)) == rows(want.select(*columns)) and got.count() == base.count()


def test_changes_equal_batch_over_batches_and_restart(spark, sf, tmp_path):
    base = states(v.live_base(spark, sf))
    source = str(tmp_path / "in")
    hours = [("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2025-01-01")]

    def run():
        stream = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(source)
        changed = sc.detect_changes(stream, "incident_id", "event_time", "seq")
        out = changed.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        out.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()

    for low, high in hours:
        part = base.where(F.col("event_time").between(low, high) & (F.col("event_time") < high))
        part.coalesce(1).write.mode("append").parquet(source)
        run()
    want = ch.published_changes(ch.change_status(base, "incident_id", "event_time", "seq"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got.select("event_id", "change_status")) == rows(want.select("event_id", "change_status"))


def test_window_metrics_equal_batch_for_finished_windows(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    for low, high in (("2024-01-01", "2024-01-12"), ("2024-01-12", "2024-01-21"), ("2024-01-21", "2025-01-01")):
        part = events.where((F.col("ts") >= low) & (F.col("ts") < high))
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = sm.stream_throughput(stream, "12 hours", time="ts", latency="value").writeStream.format("parquet")
    out = out.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    out.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = sm.stream_throughput(events, "12 hours", time="ts", latency="value")
    keep = ["window_start", "event_count", "max_latency_ms"]
    newest = got.agg(F.max("window_end")).head()[0]
    assert got.count() > 10
    assert rows(got.select(*keep)) == rows(want.where(F.col("window_end") <= newest).select(*keep))


def test_trigger_interval(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = sp.replay_messages(text_source(spark, str(tmp_path / "in")))
    query = sp.start_replay(stream, config(tmp_path, seconds=15, name="timed"))
    try:
        assert query.isActive and query.name == "timed"
    finally:
        query.stop()


@pytest.mark.parametrize("keep", [[], ["Street"]])
def test_features_or_reason_covers_every_row(spark, sf, keep):
    raw = v.raw_replay(spark, sf).select(*RAW_COLUMNS)
    both = features_or_reason(raw, keep)
    good = both.where("reject_reason is null").drop("reject_reason", "message")
    assert both.count() == raw.count() and rows(good) == rows(build_features(raw, keep))


def test_failures_beyond_the_restarts_are_raised(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    from roadpulse.streaming.running import run_until_drained

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"ID": "A", "Severity": "2", "Start_Time": "2020-01-01 01:00:00", "Start_Lat": "1", "Start_Lng": "2"}\n')
    seen = []

    def fails(batch_id):
        seen.append(batch_id)
        if len(seen) < 4:
            raise RuntimeError("again")

    conf = config(tmp_path, after_write=fails)
    start = lambda: sp.start_replay(sp.replay_messages(text_source(spark, str(tmp_path / "in"))), conf)
    with pytest.raises(StreamingQueryException):
        run_until_drained(start, restarts=1)
    assert run_until_drained(start, restarts=3) == 1 and seen == [0, 0, 0, 0]
    table = KeyedTable(spark, conf.table, REPLAY_SCHEMA, sp.KEY, sp.ORDER)
    assert table.batch_numbers() == [0] and table.written().count() == 1
