"""The ways meant for large or skewed inputs, against brute force on small ones."""

import itertools
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from roadpulse.operators import evaluate as ev
from roadpulse.operators import hotspots as hot
from roadpulse.operators import ml, profile, sampling
from roadpulse.operators.changes import change_status
from roadpulse.operators.keyed import latest_per_key, upsert
from roadpulse.operators.quantiles import exact_percentiles, running_totals
from roadpulse.operators.weather import join_weather
from roadpulse.schemas import MODEL_FEATURES


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """Three groups of very different size; a third of the values are one number."""
    rng = random.Random(5)
    pick = lambda: rng.choice([5.0, rng.random() * 100, rng.gauss(0, 1e-6)])
    data = [(g, pick()) for g, n in (("a", 3000), ("b", 7), ("c", 1)) for _ in range(n)] + [("b", None), ("b", float("nan"))]
    return spark.createDataFrame(data, "g string, x double").cache()


@pytest.mark.parametrize("accuracy", [200, 1000, 20_000])
def test_percentiles_equal_the_built_in(spark, skewed, accuracy):
    marks = {"low": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "high": 1.0}
    whole = skewed.where("x is not null and not isnan(x)")
    got = exact_percentiles(skewed, "x", marks, ["g"], accuracy)
    want = whole.groupBy("g").agg(*[F.percentile("x", p).alias(n) for n, p in marks.items()])
    for a, b in zip(rows(got), rows(want)):
        assert a[0] == b[0] and all(math.isclose(x, y, rel_tol=1e-12) for x, y in zip(a[1:], b[1:]))


def test_percentiles_order_only_what_lies_near_a_rank(spark):
    """Half a million rows in two groups, one of them without a name, a third of each a single value."""
    value = F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.abs(F.xxhash64("id")) % 1_000_003 / 1000.0 - F.col("id") % 7)
    df = spark.range(500_000).select(F.when(F.col("id") % 5 > 0, "a").alias("g"), value.alias("x"))
    marks = {"p50": 0.5, "p333": 0.3334, "p95": 0.95, "p99": 0.99}
    got = exact_percentiles(df, "x", marks, ["g"], 5000)
    want = df.groupBy("g").agg(*[F.percentile("x", p).alias(n) for n, p in marks.items()])
    for a, b in zip(rows(got), rows(want)):
        assert a[0] == b[0] and all(math.isclose(x, y, rel_tol=1e-12) for x, y in zip(a[1:], b[1:]))
    whole = exact_percentiles(df, "x", marks, accuracy=5000)
    assert all(math.isclose(x, y, rel_tol=1e-12) for x, y in zip(whole.head(), df.agg(*[F.percentile("x", p) for p in marks.values()]).head()))
    assert _rows_of(spark, got, "WindowExec") < 10_000  # of 320,000 distinct values


def _rows_of(spark, df, node):
    """Rows that reach the nodes of a kind, by the plan's own metrics."""
    df.collect()

    def walk(plan):
        name = plan.getClass().getSimpleName()
        inner = plan.executedPlan() if name == "AdaptiveSparkPlanExec" else plan.plan() if name.endswith("QueryStageExec") else None
        if inner is not None:
            return walk(inner)
        below = [plan.children().apply(i) for i in range(plan.children().length())]
        here = max((_first_rows(c) for c in below), default=0) if name == node else 0
        return max([here, *map(walk, below)])

    def _first_rows(plan):
        while True:
            metric = plan.metrics().get("numOutputRows")
            if metric.isDefined() and metric.get().value() > 0:
                return metric.get().value()
            name = plan.getClass().getSimpleName()
            plan = plan.plan() if name.endswith("QueryStageExec") else plan.children().apply(0)

    return walk(df._jdf.queryExecution().executedPlan())


def test_chunked_running_totals_equal_one_window(spark, skewed):
    whole = skewed.where("x is not null and not isnan(x)")
    measures = {"n": F.count("*"), "big": F.count_if(F.col("x") > 1)}
    got = running_totals(whole, ["g"], "x", measures, chunks=64)
    smaller = Window.partitionBy("g").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    counts = whole.groupBy("g", "x").agg(*[c.alias(n) for n, c in measures.items()])
    want = counts.withColumns({f"before_{n}": F.coalesce(F.sum(n).over(smaller), F.lit(0)) for n in measures})
    assert rows(got) == rows(want)


def test_limits_travel_to_the_counts(spark, skewed):
    """A task that streams the limits holds them once for every value of a group; of a forest's scores that is all memory."""
    ranked = running_totals(skewed.where("not isnan(x)"), ["g"], "x", {"n": F.count("*")})
    joins = [line for line in ranked._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert any("rightHint=(strategy=broadcast)" in line for line in joins)


def test_forests_remember_the_nodes_of_rows(spark):
    rows = spark.range(400).select(
        F.concat(F.lit("e"), "id").alias("event_id"), (F.col("id") % 4 + 1).cast("int").alias("true_severity"),
        *[(F.col("id") * (7 + i) % (11 + i)).cast("double").alias(c) for i, c in enumerate(MODEL_FEATURES)])
    forests = [e for e in [*ml.estimators().values(), *ml.search_grid().values()] if type(e).__name__ == "RandomForestClassifier"]
    assert len(forests) == 5 and all(f.getCacheNodeIds() for f in forests)
    trees = [ml.train(rows, ml.forest(5, 6).setCacheNodeIds(kept)).stages[-1].toDebugString.split("\n", 1)[1] for kept in (True, False)]
    assert trees[0] == trees[1]


def _meters(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371008.8 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("radius", [5_000.0, 40_000.0, 400_000.0])
def test_radius_join_equals_brute_force(spark, radius):
    """Dense spots, the date line, both poles."""
    rng = random.Random(11)
    spots = [(40.7, -74.0), (0.0, 179.99), (0.0, -179.99), (89.9, 10.0), (-89.95, -120.0), (60.0, 0.0)]
    near = lambda s: (max(-90.0, min(90.0, s[0] + rng.gauss(0, 0.2))), max(-180.0, min(180.0, s[1] + rng.gauss(0, 0.3))))
    events = [(f"e{i}", *near(rng.choice(spots))) for i in range(300)] + [(f"h{i}", 40.7, -74.0) for i in range(100)]
    centers = [(f"c{i}", *near(rng.choice(spots))) for i in range(40)]
    e = spark.createDataFrame(events, "event_id string, lat double, lon double")
    c = spark.createDataFrame(centers, "center_id string, center_lat double, center_lon double")
    got = {(r["center_id"], r["event_id"]) for r in hot.nearby_join(e, c, radius).collect()}
    pairs = [(x[0], y[0]) for x, y in itertools.product(centers, events) if _meters(x[1:], y[1:]) <= radius]
    assert got == set(pairs) and len(got) == len(pairs) and hot.nearby_join(e, c, radius).count() == len(pairs)


def test_crowded_place_costs_one_pair(spark):
    """Ten thousand centers and events at one place: counted and ranked without their hundred million pairs."""
    e = spark.range(10_000).selectExpr("concat('e', lpad(id, 5, '0')) as event_id", "40.0d as lat", "-70.0d as lon")
    c = spark.range(10_000).selectExpr("concat('c', id) as center_id", "40.001d as center_lat", "-70.0d as center_lon")
    total = hot.nearby_totals(e, c, 500.0).agg(F.count("*"), F.sum("n")).head()
    assert tuple(total) == (10_000, 100_000_000)
    near = hot.nearest_per_center(e, c, 500.0, 2)
    assert near.count() == 20_000 and {r["event_id"] for r in near.select("event_id").distinct().collect()} == {"e00000", "e00001"}
    assert hot.centers_around(e, c, 500.0).select(F.sum("n")).head()[0] == 100_000_000


def test_null_groups_stay(spark):
    rows_ = spark.createDataFrame([("a", None, 1), ("a", "p", 2), ("b", None, 3), (None, None, 4)], "key string, grp string, seq int")
    assert sampling.sample_per_group(rows_, "grp", "key", 10).count() == 4
    timed = rows_.withColumn("time", F.when(F.col("seq") > 2, F.current_timestamp().cast("timestamp_ntz")))
    assert change_status(timed, "key", "time", "seq").count() == 4
    got = {r["grp"]: r["m"] for r in exact_percentiles(rows_, "seq", {"m": 0.5}, ["grp"]).collect()}
    assert got == {None: 3.0, "p": 2.0}


def test_correlation_is_pairwise_and_relative(spark):
    rng = random.Random(5)
    data = [("p", x, x * 1e-7, 3 * x if i % 3 else None) for i in range(500) for x in [50 + rng.random()]]
    df = spark.createDataFrame(data, "period string, a double, tiny double, holed double")
    got = {(r["feature"], r["other"]): r["correlation"] for r in profile.corr_matrix(df, ["a", "tiny", "holed"]).collect()}
    assert all(math.isclose(v, 1.0, abs_tol=1e-6) for v in got.values()) and len(got) == 9


def test_hash_cap_keeps_exactly_the_first_rows(spark):
    data = [(f"k{i}", 0 if i % 10 else i % 3) for i in range(3000)]
    df = spark.createDataFrame(data, "key string, grp int")
    for n in (1, 17, 900, 5000):
        got = {r["key"] for r in sampling.sample_per_group(df, "grp", "key", n).collect()}
        ranked = df.select("key", "grp", sampling.key_hash("key").alias("h")).collect()
        want = set()
        for g in (0, 1, 2):
            want |= {r["key"] for r in sorted((r for r in ranked if r["grp"] == g), key=lambda r: (r["h"], r["key"]))[:n]}
        assert got == want
    for total in (10, 333, 10_000):
        kept = sampling.stratified_cap(df, "grp", "key", total)
        assert kept.count() == min(total, 3000)


def test_hotspot_mode_counts_and_nulls(spark):
    data = [(1.0, 2.0, 0.5, True, 7), (1.0, 2.0, 0.7, False, 9), (1.0, 2.0, 0.1, False, None), (1.0, 2.0, None, True, 9), (5.0, 5.0, None, True, 1)]
    df = spark.createDataFrame(data, "lat double, lon double, risk_score double, is_severe boolean, hour int")
    (row,) = hot.hotspots(df, 1).collect()
    assert (row["accident_count"], row["severe_count"], row["peak_hour"]) == (3, 1, 7)
    assert math.isclose(row["avg_risk_score"], 1.3 / 3)


def test_latest_row_orders_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame([("a", None, 9), ("a", 1, 2), ("a", 1, 5), ("b", None, 1)], "k string, t int, v int")
    assert rows(latest_per_key(df, "k", ["t"])) == [("a", 1, 5), ("b", None, 1)]


def test_upsert_keeps_creation_time(spark):
    table = spark.sql("select 'a' k, 1 v, timestamp_ntz '2024-01-01' updated_at, timestamp_ntz '2024-01-01' created_at")
    batch = spark.createDataFrame([("a", 2), ("a", 3), ("b", 1)], "k string, v int")
    got = upsert(table, batch, "k", ["v"], now="2024-02-02 00:00:00")
    assert rows(got.select("k", "v", F.month("updated_at"), F.month("created_at"))) == [("a", 3, 2, 1), ("b", 1, 2, 2)]


def test_weather_takes_the_nearest_slot_and_the_earlier_on_a_tie(spark):
    slots = spark.sql(
        "select 1.0d cell_lat, 2.0d cell_lon, date'2024-01-01' obs_date, s slot, c weather_code, 1d temperature_f, 1d humidity, 1d wind_speed_mph"
        " from values (timestamp_ntz'2024-01-01 03:00', 3), (timestamp_ntz'2024-01-01 05:00', 5), (timestamp_ntz'2024-01-01 05:00', 6), (null, 9) as t(s, c)"
    )
    events = spark.sql(
        "select * from values ('a', timestamp_ntz'2024-01-01 04:59'), ('b', timestamp_ntz'2024-01-01 05:10'), ('c', timestamp_ntz'2024-01-02 05:10') as t(id, t)"
    ).selectExpr("id", "t", "1.001d lat", "2.004d lon")
    got = join_weather(events, slots, "lat", "lon", "t").select("id", "wx_weather_code")
    assert rows(got) == [("a", 3), ("b", 5), ("c", None)]


def test_correlation_over_many_batches(spark):
    rng = random.Random(2)
    data = [("p", -100 + rng.random(), i + rng.random(), 7.0) for i in range(2000)]
    df = spark.createDataFrame(data, "period string, a double, b double, k double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = {(r["feature"], r["other"]): r["correlation"] for r in profile.corr_matrix(df, ["a", "b", "k"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert math.isclose(got["a", "b"], df.stat.corr("a", "b"), abs_tol=1e-9)
    assert math.isclose(got["a", "a"], 1.0) and got["a", "k"] is None


def test_auc_against_pair_counting(spark):
    rng = random.Random(7)
    data = [(rng.choice([1, 2]), round(rng.random(), 1)) for _ in range(200)]
    df = spark.createDataFrame([(a, s, 1 - s) for a, s in data], "a int, p1 double, p2 double")
    pos, neg = [s for a, s in data if a == 1], [s for a, s in data if a != 1]
    want = sum((x > y) + 0.5 * (x == y) for x in pos for y in neg) / (len(pos) * len(neg))
    got = {r["class_label"]: r["auc"] for r in ev.class_auc(df, "a", {1: "p1", 2: "p2"}).collect()}
    assert math.isclose(got[1], want) and math.isclose(got[2], want)


def test_neighbours_of_all_rows(spark):
    rng = random.Random(9)
    point = lambda i: (f"k{i}", rng.choice([1, 2, 3]), float(rng.randint(0, 4)), float(rng.randint(0, 4)))
    train, test = [point(i) for i in range(120)], [point(i + 500) for i in range(30)]
    ddl = "event_id string, true_severity int, lat double, lon double"
    got = ml.knn(
        spark.createDataFrame(train, ddl), spark.createDataFrame(test, ddl), "event_id", columns=["lat", "lon"], k=6
    )
    want = []
    for key, _, x, y in test:
        near = sorted(train, key=lambda r: ((x - r[2]) ** 2 + (y - r[3]) ** 2, r[0]))[:6]
        counts = {c: sum(r[1] == c for r in near) for c in (1, 2, 3)}
        want.append((key, max(counts, key=lambda c: (counts[c], -c))))
    assert rows(got) == sorted(want, key=repr)


def test_learning_beats_the_majority(spark, tmp_path):
    """A planted signal is found, the model survives storage, and gaps in a row give no prediction."""
    from roadpulse.plans.train import compare_classifiers, load_latest, save_model, train_job

    rng = random.Random(1)
    data = []
    for i in range(900):
        values = [rng.random() for _ in MODEL_FEATURES]
        data.append((f"e{i}", 1 + int(values[2] * 2.2) + int(values[6] > 0.8), *values))
    ddl = "event_id string, true_severity int, " + ", ".join(f"{c} double" for c in MODEL_FEATURES)
    df = spark.createDataFrame(data, ddl).cache()
    grid = {k: e for k, e in ml.search_grid((5,), (4,), 1).items() if k.startswith(("tree", "logistic r0.01"))}
    root = str(tmp_path / "models")
    result = train_job(df, root, grid, str(tmp_path / "eval"), str(tmp_path / "runs"), "r1", "2024-01-01 00:00:00")
    majority = max(df.groupBy("true_severity").count().collect(), key=lambda r: r["count"])["count"] / 900
    assert result["version"] == 1 and result["metrics"]["accuracy"] > majority + 0.1
    assert spark.read.parquet(str(tmp_path / "runs")).head()["run_id"] == "r1"
    model = load_latest(spark, root)
    holed = df.withColumn("hour", F.when(F.col("event_id") != "e5", F.col("hour")))
    scored = ml.score(holed, model)
    assert scored.count() == 900 and scored.where("predicted_severity is null").count() == 1
    total = scored.where("p1 is not null").select(F.max(F.abs(F.col("p1") + F.col("p2") + F.coalesce("p3", F.lit(0)) + F.coalesce("p4", F.lit(0)) - 1)))
    assert total.head()[0] < 1e-9
    assert save_model(model, root) == 2
    again = ml.score(df, load_latest(spark, root)).select("event_id", "predicted_severity", "p1")
    assert rows(again) == rows(ml.score(df, model).select("event_id", "predicted_severity", "p1"))
    table = compare_classifiers(*sampling.hash_split(df, "event_id", 80), trees=5, iterations=20).collect()
    assert {"KNN (k=6)", "Random Forest", "Logistic Regression"} <= {r["model"] for r in table}
    assert [r["macro_f1"] for r in table] == sorted((r["macro_f1"] for r in table), reverse=True)
