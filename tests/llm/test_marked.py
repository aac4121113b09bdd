"""Only texts that may hold a window of the benchmark are dealt out."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.llm import decontaminate


def test_only_marked_texts_are_dealt_out(spark):
    """Every wanted row is let through, with its repeats, and hardly another one."""
    rows = spark.range(20_000).select((F.col("id") % 10_000 - 5000).alias("doc_id"), F.xxhash64((F.col("id") % 3).cast("string")).alias("digest"))
    wanted = rows.filter("doc_id % 100 = 0")
    got = decontaminate.marked(rows, wanted)
    assert got.join(wanted.distinct(), ["doc_id", "digest"], "left_semi").count() == wanted.count() and got.count() < wanted.count() + 20
    assert decontaminate.marked(rows, wanted.limit(0)).count() == 0
