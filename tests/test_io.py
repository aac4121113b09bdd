"""Readers, writers and batch jobs on small folders."""

import json

import pytest
from pyspark.sql import functions as F

from querybook import views as v
from roadpulse.operators.features import build_features
from roadpulse.plans import jobs
from roadpulse.schemas import FEATURE_COLUMNS, REPLAY_SCHEMA
from roadpulse.sources import files, sinks, streams


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Two spells of raw rows in different years, bad ones included: few dates, so few files."""
    rows = v.raw_replay(spark, "/root/testdata/sf0.01")
    spells = F.col("Start_Time").rlike("^(1996-03-0|1997-05-1|not|$)")
    path = str(tmp_path_factory.mktemp("raw") / "rows")
    rows.where(spells).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def features(raw):
    return build_features(raw).cache()


@pytest.fixture(scope="module")
def raw_csv(raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "csv")
    odd = raw.withColumnsRenamed({plain: odd for odd, plain in files.RAW_RENAMES.items()})
    odd.withColumn("Extra", F.lit('a "quoted", value')).write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_silver_round_trip_and_repeat(spark, features, tmp_path):
    path = str(tmp_path / "silver")
    for _ in range(2):
        sinks.write_silver(features, path, batch_id=3)
    back = files.read_silver(spark, path)
    assert back.columns == FEATURE_COLUMNS
    assert back.count() == features.count()
    assert rows(back.select("event_id", "lat", "hour")) == rows(features.select("event_id", "lat", "hour"))
    text = back.select("event_time").head()[0]
    assert len(text) == 19 and text[10] == "T"


def test_silver_without_time_and_with_damage(spark, features, tmp_path):
    path = tmp_path / "silver"
    lost = features.limit(1).withColumn("event_time", F.lit(None).cast("timestamp_ntz"))
    sinks.write_silver(lost, str(path))
    assert (path / f"event_date={sinks.UNKNOWN_DATE}").exists()
    (path / "broken.json").write_text('{"event_id": "x", "lat": \nnot json\n')
    assert files.read_silver(spark, str(path)).where("event_id is not null").count() >= 1


def test_gold_job(spark, features, tmp_path):
    silver, gold, csv = (str(tmp_path / n) for n in ("silver", "gold", "csv"))
    sinks.write_silver(features, silver, 0)
    sinks.write_silver(features.limit(20), silver, 1)
    first = jobs.silver_to_gold(spark, silver, gold, csv)
    again = jobs.silver_to_gold(spark, silver, gold, csv)
    n = features.count()
    assert first == again == {"read": n + 20, "written": n}
    back = spark.read.parquet(gold)
    assert back.count() == n and back.select("event_id").distinct().count() == n
    assert dict(back.dtypes)["humidity"] == "float" and (tmp_path / "gold" / "event_year=1996").exists()
    assert spark.read.option("header", True).csv(csv).count() == n


def test_gold_job_keeps_old_output_when_nothing_qualifies(spark, features, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    sinks.write_silver(features.withColumn("true_severity", F.lit(9)), silver, 0)
    assert jobs.silver_to_gold(spark, silver, gold)["written"] == 0
    assert not (tmp_path / "gold").exists()


def test_gold_dynamic_overwrite_leaves_other_years(spark, features, tmp_path):
    gold = str(tmp_path / "gold")
    sinks.write_gold_parquet(features, gold)
    sinks.write_gold_parquet(features.where("event_year = 1996").limit(1), gold, dynamic=True)
    back = spark.read.parquet(gold)
    assert back.where("event_year = 1996").count() == 1
    assert back.where("event_year = 1997").count() == features.where("event_year = 1997").count()


def test_csv_names_and_extra_columns(spark, raw, raw_csv):
    back = files.read_raw_csv(spark, raw_csv)
    assert "Temperature_F" in back.columns and "Extra" in back.columns
    assert back.select("Extra").head()[0] == 'a "quoted", value'
    assert rows(build_features(back)) == rows(build_features(raw))
    assert files.read_raw_csv(spark, raw_csv, columns=["ID", "Severity"]).columns == ["ID", "Severity"]


def test_training_file_counts(spark, raw, raw_csv, tmp_path):
    out = str(tmp_path / "train")
    counts = jobs.offline_features(spark, raw_csv, out)
    n, kept = raw.count(), build_features(raw).count()
    assert counts == {"processed": n, "written": kept, "skipped": n - kept}
    loaded = files.load_training(spark, out)
    assert loaded.columns == FEATURE_COLUMNS and loaded.count() == kept
    assert files.load_training(spark, raw_csv).count() == kept
    with pytest.raises(ValueError, match="missing"):
        files.as_training(spark.range(1).toDF("ID"))


def test_split_job(spark, raw_csv, raw, tmp_path):
    counts = jobs.split_raw(spark, raw_csv, str(tmp_path / "split"), 1997)
    assert counts["total"] == raw.count() == counts["train"] + counts["pipeline"] + counts["invalid"]
    train = spark.read.option("header", True).csv(str(tmp_path / "split" / "side=train"))
    assert train.count() == counts["train"] and "Start_Time" in train.columns


def test_latest_snapshot(spark, tmp_path):
    for i, name in enumerate(["20240101_01", "20240301_09", "20240201_23"]):
        spark.range(i + 1).write.parquet(str(tmp_path / "snap" / name))
    spark.range(9).write.parquet(str(tmp_path / "fallback"))
    assert files.read_latest_snapshot(spark, str(tmp_path / "snap"), "nowhere").count() == 2
    assert files.read_latest_snapshot(spark, str(tmp_path / "none"), str(tmp_path / "fallback")).count() == 9


def test_serving_table_may_be_missing(spark):
    empty = files.read_serving(spark, "no_such_table", REPLAY_SCHEMA)
    assert empty.count() == 0 and empty.columns == REPLAY_SCHEMA.names


def test_payload_documents(spark, tmp_path):
    incident = {"properties": {"id": "1"}, "geometry": {"type": "Point", "coordinates": [1.5, 2]}}
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text(json.dumps({"incidents": [incident, incident]}) + "\nbroken {\n" + json.dumps({"incidents": []}))
    got = files.read_incident_payloads(spark, str(tmp_path / "docs"))
    assert got.count() == 2 and got.select("incident.geometry.coordinates").head()[0] == "[1.5,2]"


LOG = """Best model ID: GBM_1
Evaluating model rank 1: XGB_7 (xgboost)
  accuracy: 0.1
Evaluating model rank 2: GBM_1 (gbm)
  Logloss: 0.55
  accuracy: 0.79
  macro_f1: N/A
  Per-class classification report:
     class_label  precision  recall  f1  support
  0  1  0.5  0.25  0.3333  12
  1  2  0.9  0.95  0.9243  900
  Confusion matrix table:
  0  9  9  9  9  9
Evaluating model rank 3: XGB_9 (xgboost)
  accuracy: 0.2
"""


def test_metric_log(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "run.log").write_text(LOG)
    row = files.read_metric_log(spark, str(tmp_path / "log")).head()
    assert (row["model"], row["logloss"], row["accuracy"], row["macro_f1"], row["rmse"]) == ("GBM_1", 0.55, 0.79, None, None)
    classes = files.read_class_log(spark, str(tmp_path / "log")).orderBy("class_label").collect()
    assert [(r["class_label"], r["recall"], r["support"]) for r in classes] == [("1", 0.25, 12), ("2", 0.95, 900)]


def test_large_logs_are_read_in_splits(spark, tmp_path):
    """A block that begins in one split and ends in another, among logs of other models."""
    (tmp_path / "log").mkdir()
    noise = "".join(f"  progress {i} of the search\n" for i in range(3000))
    long_log = LOG.replace("  Logloss", noise + "  Logloss").replace("  1  2  0.9", noise + "  1  2  0.9").replace("  2  ", "  2  ")
    (tmp_path / "log" / "a.log").write_text(noise + long_log)
    (tmp_path / "log" / "b.log").write_text(LOG.replace("GBM_1", "DRF_3").replace("0.79", "0.5"))
    (tmp_path / "log" / "c.log").write_text("no model here\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        assert files._log_lines(spark, str(tmp_path / "log")).rdd.getNumPartitions() > 5
        got = {(r["model"], r["logloss"], r["accuracy"]) for r in files.read_metric_log(spark, str(tmp_path / "log")).collect()}
        classes = sorted((r["model"], r["class_label"], r["precision"], r["support"]) for r in files.read_class_log(spark, str(tmp_path / "log")).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {("GBM_1", 0.55, 0.79), ("DRF_3", 0.55, 0.5)}
    assert classes == [("DRF_3", "1", 0.5, 12), ("DRF_3", "2", 0.9, 900), ("GBM_1", "1", 0.5, 12), ("GBM_1", "2", 0.9, 900)]


def test_damaged_documents_are_kept_apart(spark, tmp_path):
    (tmp_path / "docs" / "region=0").mkdir(parents=True)
    good = json.dumps({"incidents": [{"properties": {"id": "1"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]})
    (tmp_path / "docs" / "region=0" / "a.json").write_text(f"{good}\n{good[:40]}\n\n[]\nnull\n{{}}\n{good}\n")
    documents = files.read_payload_documents(spark, str(tmp_path / "docs"))
    assert documents.count() == 6 and documents.where(F.col("damaged") == good[:40]).count() == 1
    rows_ = files.incidents_of(documents)
    assert rows_.count() == 2 and {r["region"] for r in rows_.collect()} == {0}


def test_keyed_table_batches_repeat_and_compact(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), REPLAY_SCHEMA, "event_id", ["processed_time"])
    assert not table.exists() and table.read().count() == 0
    batch = lambda *r: spark.createDataFrame(
        list(r), "event_id string, hour int, processed_time string"
    ).withColumn("processed_time", F.col("processed_time").cast("timestamp_ntz"))
    table.upsert(batch(("a", 1, "2024-01-01"), ("a", 2, "2024-01-02"), ("b", 1, "2024-01-01")), 0, now="2024-02-01")
    table.upsert(batch(("b", 7, "2023-01-01"), ("c", 3, None)), 1, now="2024-02-02")
    table.upsert(batch(("b", 8, "2023-01-01"), ("c", 3, None)), 1, now="2024-02-03")
    want = [("a", 2, 1, 1), ("b", 8, 3, 1), ("c", 3, 3, 3)]
    look = lambda: rows(table.read().select("event_id", "hour", F.day("updated_at"), F.day("created_at")))
    assert look() == want
    table.compact()
    assert look() == want
    table.upsert(batch(("a", 9, None)), 2, now="2024-02-04")
    assert look() == [("a", 9, 4, 1), *want[1:]]
    (tmp_path / "t" / "base" / "upto=2").mkdir()
    assert look() == [("a", 9, 4, 1), *want[1:]], "a base without its marker must not count"


def test_messages_and_topic_options(spark):
    df = spark.createDataFrame([("e1", 1), (" ", None)], "event_id string, n int")
    got = streams.message(df).collect()
    assert got[0]["key"] == "e1" and json.loads(got[0]["value"]) == {"event_id": "e1", "n": 1}
    assert got[1]["key"].startswith("row-") and json.loads(got[1]["value"])["n"] is None
    options = streams.kafka_options("t", "h:1", failOnDataLoss="false")
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "false"}


def test_local_replay(spark, raw, tmp_path):
    counts = jobs.local_replay(spark, raw, str(tmp_path))
    assert counts["written"] == build_features(raw).count()
    report = spark.read.parquet(str(tmp_path / "report")).head()
    assert report["rows"] == counts["written"] and report["throughput_tps"] > 0


def test_profile_report(spark, features, tmp_path):
    from roadpulse.operators.profile import concat_periods

    halves = {"a": features.where("event_year < 1997"), "b": features.where("event_year >= 1997")}
    jobs.profile_report(concat_periods(halves, {"a": "x", "b": "y"}), str(tmp_path / "out"), ["a", "b"])
    assert len(list((tmp_path / "out").iterdir())) == 16
    assert spark.read.parquet(str(tmp_path / "out" / "overview")).count() == 2
