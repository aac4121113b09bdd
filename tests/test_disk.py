"""What jobs leave on the disk that executors share."""

from __future__ import annotations

from pathlib import Path

from querybook import training
from roadpulse.plans import jobs
from roadpulse.sources.sinks import write_silver


def test_gold_leaves_no_staged_rows(spark, sf, tmp_path):
    """Silver to Gold, with rows and without: the staged copy of the cleaned rows goes, Gold stays."""
    from querybook import views

    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    write_silver(views.feature_table(spark, sf), str(tmp_path / "silver"), batch_id=0)
    before = set(shared.glob("roadpulse-gold-*"))
    counts = jobs.silver_to_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), str(tmp_path / "csv"))
    assert counts["written"] and spark.read.parquet(str(tmp_path / "gold")).count() == counts["written"]
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == counts["written"]
    assert set(shared.glob("roadpulse-gold-*")) == before


def test_silver_of_retraining_is_compressed(spark, sf):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("roadpulse-retrain-*"))
    assert [r["written"] for r in training.retrain_job(spark, sf).orderBy("run").collect()][0] > 0
    (folder,) = set(shared.glob("roadpulse-retrain-*")) - before
    files = [f.name for f in folder.glob("silver/*/part-*")]
    assert files and all(f.endswith(".json.gz") for f in files)
