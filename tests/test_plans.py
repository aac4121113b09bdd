"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from querybook import views as v
from roadpulse.operators import hotspots as hot
from roadpulse.operators.serving import map_points, Sources

QUERIES = entry.queries()
NO_PYTHON = [
    "clean_numbers", "clean_flags", "parse_event_time", "time_features", "weather_code", "road_type_code", "build_features",
    "reject_reasons", "risk_write", "risk_read_replay", "risk_read_live", "risk_level", "live_severity", "infer_severity",
    "score_with_fallback", "heuristic_severity", "gold_clean", "hotspots", "map_points", "weather_asof", "change_status",
    "nearby_join", "class_auc", "stratified_cap", "live_features", "latency",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_PYTHON)
def test_no_python_and_no_cross_joins(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


def test_filters_and_columns_reach_the_scan(spark, sf):
    sources = Sources(replay=v.replay(spark, sf))
    text = plan(map_points(sources, bbox="-100,30,-90,40", start="1996-01-01 00:00:00", mode="replay"))
    for wanted in ("GreaterThanOrEqual(lon,-100.0)", "LessThanOrEqual(lat,40.0)", "GreaterThanOrEqual(event_time,1996-01-01T00:00)"):
        assert wanted in text, wanted
    assert "humidity" not in text and "is_railway" not in text


def test_single_point_search_is_a_range_scan(spark, sf):
    text = plan(hot.nearby(v.replay(spark, sf), 35.0, -100.0))
    assert "GreaterThanOrEqual(lat," in text and "Exchange" not in text and "TakeOrderedAndProject" in text


def test_default_range_is_a_subquery_not_a_join(spark, sf):
    text = plan(hot.top_hotspots(Sources(replay=v.replay(spark, sf))))
    assert "Subquery" in text and "Join" not in text


def test_newest_rows_are_a_bounded_top_n(spark, sf):
    text = plan(map_points(v.sources(spark, sf), limit=10))
    assert text.count("TakeOrderedAndProject") >= 2 and "Exchange rangepartitioning" not in text


def test_weather_join_has_one_shuffle_of_the_events_at_most(spark, sf):
    events = v.live_base(spark, sf).select("event_id", "latitude", "longitude", "event_time")
    from roadpulse.operators.weather import join_weather

    joined = join_weather(events, v.hourly_weather(spark, sf), "latitude", "longitude", "event_time")
    text = plan(joined)
    assert "Window" not in text and text.count("HashJoin") + text.count("SortMergeJoin") == 1
    # At most one match per event: a count does not even look at the weather.
    assert "Join" not in plan(joined.select(F.count("*")))


def test_latest_rows_need_no_sort_aggregate(spark, sf):
    """The latest row of a key, Gold cleaning and upserts rank rows; none carries whole rows through an aggregate."""
    for name in ("latest_per_key", "gold_clean", "upsert_latest"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "Window" in plan


def test_a_model_scores_its_test_rows_once(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from roadpulse.operators import ml

    rows = spark.range(400).select(
        (F.col("id") % 4 + 1).cast("int").alias("true_severity"), (F.col("id") % 4 + F.col("id") % 3 / 10).alias("temperature_f"), (F.col("id") % 5).cast("double").alias("hour"))
    model = ml.train(rows, DecisionTreeClassifier(maxDepth=4))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    row = ml.evaluate(model, rows.mapInArrow(counted, rows.schema), "tree").head()
    assert read.value == 400
    assert row["accuracy"] == 1.0 and row["logloss"] < 1e-9 and row["auc_macro_ovr"] == 1.0 and row["mse"] == 0.0
