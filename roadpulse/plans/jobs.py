"""Batch jobs: Silver to Gold, offline features, split by year, replay, profile report."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.risk import score_with_fallback
from ..operators.features import build_features, drop_required, fill_defaults, valid_range
from ..operators.health import run_report
from ..operators.keyed import latest_per_key
from ..schemas import REPLAY_SCHEMA
from ..session import shared_folder, staged
from ..sources.files import finished_folders, read_raw_csv, read_silver
from ..sources.sinks import (
    KeyedTable,
    write_gold_csv,
    write_gold_parquet,
    write_silver,
    write_split,
    write_training,
)


def gold_clean(silver: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Silver rows that qualify for Gold: complete, in range, holes filled, one row per event."""
    rows = fill_defaults(valid_range(drop_required(silver)))
    return latest_per_key(rows, "event_id", order_by or ["event_time"])


def silver_to_gold(spark: SparkSession, silver_path: str, gold_path: str, csv_path: str | None = None) -> dict:
    """Silver files to Gold; returns rows read and written. Nothing is replaced when no row qualifies.

    The cleaned rows are staged once in the shared folder: the emptiness test, the Parquet and the CSV
    then read the staged files instead of cleaning three times. The staged files go when Gold is written.
    """
    seen = Observation("silver")
    raw = read_silver(spark, silver_path).observe(seen, F.count(F.lit(1)).alias("n"))
    with staged(gold_clean(raw), "gold") as rows:
        read, written = seen.get["n"], rows.count()
        if written:
            write_gold_parquet(rows, gold_path)
            if csv_path:
                write_gold_csv(rows, csv_path)
    return {"read": read, "written": written}


def offline_features(spark: SparkSession, raw_csv: str, out: str) -> dict[str, int]:
    """Raw CSV to training CSV; fails when no row qualifies."""
    counts = write_training(read_raw_csv(spark, raw_csv), out)
    if not counts["written"]:
        raise ValueError("no valid training rows were written")
    return counts


def split_raw(spark: SparkSession, raw_csv: str, out: str, year: int = 2020) -> dict[str, int]:
    """Raw CSV to the two sides of a split by year."""
    return write_split(read_raw_csv(spark, raw_csv), out, year)


def score_replay(features: DataFrame, model=None, fallback: float = -1.0, now=None) -> DataFrame:
    """Feature rows to serving rows: predicted severity, risk, status, processing time, latency.

    Without a model a ``predicted_severity`` column of the input is used if there is one.
    """
    from ..functions.clean import latency_ms

    if model is not None:
        from ..operators.ml import score

        features = score(features.drop("predicted_severity"), model)
    elif "predicted_severity" not in features.columns:
        features = features.withColumn("predicted_severity", F.lit(None).cast("int"))
    risk, status = score_with_fallback(fallback)
    stamp = (F.lit(now) if now is not None else F.localtimestamp()).cast("timestamp_ntz")
    scored = features.withColumns({"risk_score": risk, "model_status": status, "processed_time": stamp})
    if "ingestion_time" not in scored.columns:
        scored = scored.withColumn("ingestion_time", F.lit(None).cast("timestamp_ntz"))
    return scored.withColumn("end_to_end_latency_ms", latency_ms(F.col("ingestion_time"), F.col("processed_time")))


def local_replay(spark: SparkSession, raw: DataFrame, out: str, model=None) -> dict:
    """Raw rows end to end: Silver, Gold, serving table and the report of the run."""
    start = time.monotonic()
    features = build_features(raw)
    write_silver(features, f"{out}/silver", batch_id=0)
    counts = silver_to_gold(spark, f"{out}/silver", f"{out}/gold", f"{out}/gold_csv")
    table = KeyedTable(spark, f"{out}/serving", REPLAY_SCHEMA, "event_id", ["processed_time", "ingestion_time"])
    table.upsert(score_replay(features.withColumn("ingestion_time", F.localtimestamp()), model), batch_id=0)
    report = run_report(table.read(), time.monotonic() - start)
    report.write.mode("overwrite").parquet(f"{out}/report")
    return counts


def gold_manifest(gold: DataFrame, partition: str = "event_year") -> DataFrame:
    """Rows and digest of each Gold partition; the digest does not depend on the order of rows or files."""
    row = F.xxhash64(*sorted(gold.columns)).cast("decimal(38,0)")
    return gold.groupBy(partition).agg(F.count("*").alias("rows"), F.sum(row).cast("string").alias("digest"))


def changed_partitions(now: DataFrame, before: DataFrame, partition: str = "event_year") -> DataFrame:
    """Partitions that are new, gone or different between two manifests, with their rows in both."""
    old = before.select(F.col(partition).alias("_p"), F.col("rows").alias("rows_before"), F.col("digest").alias("_digest"))
    both = now.join(old, F.col(partition).eqNullSafe(F.col("_p")), "full_outer")
    same = F.col("rows").eqNullSafe(F.col("rows_before")) & F.col("digest").eqNullSafe(F.col("_digest"))
    return both.where(~same).select(F.coalesce(partition, "_p").alias(partition), "rows", "rows_before")


def retrain_after_gold(spark: SparkSession, silver_path: str, gold_path: str, model_root: str, **options) -> dict:
    """Silver to Gold, then training on Gold, unless Gold is what the newest model was trained on.

    Each stored model has the manifest of its Gold beside it. A run whose manifest equals the newest one trains
    nothing; a run that is lost before its manifest is written trains again.
    """
    from .train import train_job

    counts = silver_to_gold(spark, silver_path, gold_path)
    if not counts["written"]:
        return {**counts, "trained": False, "changed": 0}
    gold, root = spark.read.parquet(gold_path), f"{model_root.rstrip('/')}/manifests"
    manifest = gold_manifest(gold)
    known = sorted(int(f.split("=", 1)[1]) for f in finished_folders(spark, root))
    before = spark.read.schema(manifest.schema).parquet(f"{root}/version={known[-1]}") if known else manifest.limit(0)
    changed = changed_partitions(manifest, before).count()
    if not changed:
        return {**counts, "trained": False, "changed": 0}
    outcome = train_job(gold, model_root, **options)
    manifest.write.mode("overwrite").parquet(f"{root}/version={outcome['version']}")
    return {**counts, "trained": True, "changed": changed, **outcome}


def profile_report(periods: DataFrame, out: str, names: list[str]) -> None:
    """Writes every profile table of tagged feature rows as Parquet, one folder each.

    The rows are staged once, since a dozen tables read them.
    """
    from ..operators import profile as p

    spark = periods.sparkSession
    staged_path = f"{shared_folder(spark, 'profile')}/rows"
    periods.write.mode("overwrite").parquet(staged_path)
    rows = spark.read.parquet(staged_path)
    tables = {
        "overview": p.period_overview(rows), "schema": p.schema_report(rows, names), "years": p.year_counts(rows),
        "severity_share": p.severity_share(rows), "drift": p.drift(rows, names[0], names[1]),
        "imbalance": p.imbalance(rows), "missing": p.missing_report(rows), "summary": p.numeric_summary(rows),
        "box": p.box_stats(rows), "hours": p.severity_stats(rows, ["period", "hour"]),
        "rush": p.severity_stats(rows, ["period", "is_rush_hour", "is_weekend"]),
        "weather": p.severity_stats(rows, ["period", "weather_code"]),
        "roads": p.severity_stats(rows, ["period", "road_type_code"]), "flags": p.flag_stats(rows),
        "correlation": p.corr_matrix(rows), "label_correlation": p.label_corr(rows),
    }
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")
