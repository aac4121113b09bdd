"""Nearest neighbours among all training rows, against plain Python."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from roadpulse.operators import ml, neighbours


def test_no_training_row_is_left_out(spark):
    """Each of many training rows is the only one at its place, and is found from there."""
    train = spark.range(24_000).select(
        F.format_string("k%05d", "id").alias("event_id"), (F.pmod(F.xxhash64("id"), F.lit(4)) + 1).cast("int").alias("true_severity"),
        F.col("id").cast("double").alias("lat"), (F.col("id") % 7).cast("double").alias("lon"))
    got = ml.knn(train, train.where("lat % 40 = 0").drop("true_severity"), "event_id", columns=["lat", "lon"], k=1)
    wrong = got.join(train, "event_id").where(~F.col("predicted_severity").eqNullSafe(F.col("true_severity")))
    assert got.count() == 600 and wrong.count() == 0


def _odd(rng: random.Random):
    x = rng.random()
    odd = ((0.01, None), (0.015, float("nan")), (0.02, float("inf")), (0.022, float("-inf")), (0.024, 1e200))
    return next((v for most, v in odd if x < most), float(rng.randint(0, 9)))


def test_many_cells_and_odd_rows(spark, monkeypatch):
    """Keys that repeat or are null, missing labels and features, infinite values, equal rows; cells, leaves and tasks are small."""
    monkeypatch.setattr(neighbours, "LEAF", 16)
    monkeypatch.setattr(neighbours.nearest_rows, "__defaults__", (64, 100))
    rng = random.Random(3)
    row = lambda i: (None if rng.random() < 0.01 else f"k{i % 1800}", rng.choice([1, 2, 3, 3, 2, 1, None]), *(_odd(rng) for _ in range(3)))
    train, test = [row(i) for i in range(2000)], [row(i + 500) for i in range(400)]
    ddl = "event_id string, true_severity int, a double, b double, c double"
    got = ml.knn(spark.createDataFrame(train, ddl), spark.createDataFrame(test, ddl), "event_id", columns=["a", "b", "c"])

    known = sorted((r for r in train if r[1] is not None), key=lambda r: (r[0] is None, r[0] or "", r[1]))
    numbers = lambda r: np.array([np.nan if v is None else v for v in r[2:]])
    places, want = np.array([numbers(r) for r in known]), []
    for r in test:
        with np.errstate(all="ignore"):
            total = sum((g * g for g in (numbers(r) - places).T), np.zeros(len(known)))
        near = [i for i in np.argsort(total, kind="stable") if not np.isnan(total[i])][:6]
        votes = [known[i][1] for i in near]
        want.append((r[0], min(set(votes), key=lambda v: (-votes.count(v), v)) if votes else None))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_without_labels_there_is_no_result(spark):
    train = spark.createDataFrame([("a", None, 1.0)], "event_id string, true_severity int, lat double")
    assert ml.knn(train, train, "event_id", columns=["lat"]).collect() == []
