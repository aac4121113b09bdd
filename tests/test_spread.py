"""Tables whose files are one row group each: the work on them is dealt over all tasks."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from querybook import views as v
from querybook.streams import _messages_stream


@pytest.fixture()
def one_group(spark, tmp_path):
    """Orders and events as one file of one row group each, with repeated and null keys; small shuffles are left apart."""
    n = spark.range(4000).repartition(1)
    key = F.when(F.col("id") % 50 != 0, F.col("id") % 3000 + 1)
    time = F.expr("timestamp_ntz '1996-01-01' + make_dt_interval(0, cast(id % 900 as int))")
    orders = n.select(key.alias("o_orderkey"), (F.col("id") % 700).alias("o_custkey"), (F.col("id") * 1.5).alias("o_totalprice"), time.alias("o_orderdate"))
    events = n.select(key.alias("event_id"), time.alias("ts"), (F.col("id") % 90).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") % 40 * 1.0).alias("value"))
    for name, df in (("orders", orders), ("events", events)):
        pq.write_table(df.toArrow(), tmp_path / f"{name}.parquet", coerce_timestamps="us")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield str(tmp_path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def tasks(df) -> int:
    return df.select(F.spark_partition_id()).distinct().count()


def test_views_are_made_in_many_tasks(spark, one_group):
    raw = v.raw_replay(spark, one_group)
    assert tasks(raw) > 1 and raw.count() == 4000
    assert tasks(v.live_base(spark, one_group)) > 1 and v.live_base(spark, one_group).count() == 4000
    for table in (v.feature_table, v.replay, v.live):
        assert len(table(spark, one_group).inputFiles()) > 1


def test_messages_are_made_in_many_tasks(spark, one_group, tmp_path):
    found = []
    stream = v.raw_replay_of(_messages_stream(spark, one_group, "orders"))
    writer = stream.writeStream.foreachBatch(lambda df, i: found.append((tasks(df), df.count())))
    writer.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert found[0][0] > 1 and sum(n for _, n in found) == 4000


def test_tuning_ends_with_its_block(spark):
    from roadpulse.session import METHOD_LIMIT, tuned

    before = spark.conf.get(METHOD_LIMIT)
    for outside in ("6000", None):
        spark.conf.set(METHOD_LIMIT, outside) if outside else spark.conf.unset(METHOD_LIMIT)
        default = spark.conf.get(METHOD_LIMIT)
        with tuned(spark):
            assert spark.conf.get(METHOD_LIMIT) == "8000"
        assert spark.conf.get(METHOD_LIMIT) == default
    spark.conf.set(METHOD_LIMIT, before)


def test_scoring_plans_stay_small(spark):
    """Scored rows can be planned on; the constraints of their conditions do not double with every column."""
    import threading

    from pyspark.ml.classification import DecisionTreeClassifier

    from roadpulse.operators import ml
    from roadpulse.operators.keyed import latest_per_key
    from roadpulse.plans.jobs import score_replay
    from roadpulse.schemas import MODEL_FEATURES

    names, nan = MODEL_FEATURES, float("nan")
    data = [(f"e{i}", 1 + i % 2, *[float(i % (k + 2)) for k in range(len(names))]) for i in range(60)]
    data += [("nan", 1, nan, *[1.0] * (len(names) - 1)), ("gap", 1, None, *[1.0] * (len(names) - 1))]
    df = spark.createDataFrame(data, "event_id string, true_severity int, " + ", ".join(f"{c} double" for c in names))
    model = ml.train(df.where("event_id not in ('nan', 'gap')"), DecisionTreeClassifier(maxDepth=3, seed=1))
    scored = ml.score(df, model)
    assert scored.columns == [*df.columns, "predicted_severity", "p1", "p2", "p3", "p4"] and scored.dtypes[: len(df.columns)] == df.dtypes
    found = {r["event_id"]: r for r in scored.collect()}
    assert len(found) == 62 and found["nan"][names[0]] == 0.0 and found["nan"]["predicted_severity"] is not None
    assert all(found["gap"][c] is None for c in [*names, "predicted_severity", "p1"])
    latest = latest_per_key(score_replay(df, model, now="2024-01-01 00:00:00"), "event_id", ["processed_time"])
    planning = threading.Thread(target=lambda: latest._jdf.queryExecution().optimizedPlan(), daemon=True)
    planning.start()
    planning.join(40)
    assert not planning.is_alive()
