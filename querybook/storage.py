"""What goes through files: each query writes the given tables with a sink or a job and returns what a reader finds."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.plans import jobs
from roadpulse.session import shared_folder
from roadpulse.sources import files, sinks

from . import views as v
from .profile import tagged
from .registry import Registry

query = Registry()

FACTS = "event_id, event_year, true_severity, hour, weather_code, road_type_code, is_night"
LISTED = [c.strip() for c in FACTS.split(",")]


def _raw_csv(spark, sf_dir) -> str:
    """The raw rows as CSV under their published names, in two folders that order their columns differently."""
    raw = v.raw_replay(spark, sf_dir)
    odd = raw.withColumnsRenamed({plain: name for name, plain in files.RAW_RENAMES.items()})
    path = shared_folder(spark, "raw-csv")
    first = F.pmod(F.xxhash64("ID"), F.lit(2)) == 0
    for part, rows in (("part=0", odd.where(first)), ("part=1", odd.where(~first).select(*reversed(odd.columns)))):
        rows.write.option("header", True).option("quote", '"').option("escape", '"').csv(f"{path}/{part}")
    return path


@query("silver_round_trip", v.with_views(["features"], f"select {FACTS} from features"))
def silver_round_trip(spark, sf_dir):
    """Feature rows through Silver files."""
    path = shared_folder(spark, "silver")
    sinks.write_silver(v.feature_table(spark, sf_dir), path, batch_id=7)
    return files.read_silver(spark, path).select(*LISTED)


@query(
    "gold_job",
    v.with_views(["features"], f"select 'parquet' as kind, {FACTS} from features union all select 'csv' as kind, {FACTS} from features"),
)
def gold_job(spark, sf_dir):
    """Silver files with a repeated part to Gold, as Parquet by year and as CSV."""
    folder, rows = shared_folder(spark, "gold-job"), v.feature_table(spark, sf_dir)
    sinks.write_silver(rows, f"{folder}/silver", 0)
    sinks.write_silver(rows.where(F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0), f"{folder}/silver", 1)
    jobs.silver_to_gold(spark, f"{folder}/silver", f"{folder}/gold", f"{folder}/csv")
    parquet = spark.read.parquet(f"{folder}/gold").select(F.lit("parquet").alias("kind"), *LISTED)
    return parquet.unionByName(files.load_training(spark, f"{folder}/csv").select(F.lit("csv").alias("kind"), *LISTED))


@query("raw_csv_scan", v.with_views(["features"], f"select {FACTS} from features"))
def raw_csv_scan(spark, sf_dir):
    """Raw CSV of two column orders, read and built into features."""
    path = _raw_csv(spark, sf_dir)
    parts = [files.as_training(files.read_raw_csv(spark, f"{path}/part={i}")) for i in (0, 1)]
    return parts[0].unionByName(parts[1]).select(*LISTED)


@query("training_file", v.with_views(["features"], f"select {FACTS} from features"))
def training_file(spark, sf_dir):
    """Raw CSV to a training file, read back as training rows."""
    folder = shared_folder(spark, "training")
    jobs.offline_features(spark, f"{_raw_csv(spark, sf_dir)}/part=0", f"{folder}/0")
    jobs.offline_features(spark, f"{_raw_csv(spark, sf_dir)}/part=1", f"{folder}/1")
    return files.load_training(spark, f"{folder}/0").unionByName(files.load_training(spark, f"{folder}/1")).select(*LISTED)


@query(
    "split_job",
    v.with_views(
        ["features"],
        f"select case when event_year < {v.SPLIT_YEAR} then 'train' else 'pipeline' end as side, count(*) as n, min(event_id) as first_id from features group by 1",
    ),
)
def split_job(spark, sf_dir):
    """Raw rows split by year into two CSV folders; rows that can't become features are left out of the count."""
    folder = shared_folder(spark, "split")
    sinks.write_split(v.raw_replay(spark, sf_dir), folder, v.SPLIT_YEAR)
    sides = [files.as_training(files.read_raw_csv(spark, f"{folder}/side={s}")).withColumn("side", F.lit(s)) for s in ("train", "pipeline")]
    return sides[0].unionByName(sides[1]).groupBy("side").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("latest_snapshot", v.with_views(["features"], "select event_id, hour from features"))
def latest_snapshot(spark, sf_dir):
    """The newest finished snapshot of two; a third one is still without its marker."""
    folder, rows = shared_folder(spark, "snapshots"), v.feature_table(spark, sf_dir).select("event_id", "hour")
    rows.where("hour < 6").write.parquet(f"{folder}/day=2024-01-01")
    rows.write.parquet(f"{folder}/day=2024-01-02")
    rows.where("hour < 3").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).parquet(f"{folder}/day=2024-01-03")
    return files.read_latest_snapshot(spark, folder, "none")


@query("eval_tables", v.with_views(["features"], "select true_severity, cast(count(*) as varchar) as n from features group by 1"))
def eval_tables(spark, sf_dir):
    """An evaluation table written as CSV and read back."""
    folder = shared_folder(spark, "eval")
    counts = v.feature_table(spark, sf_dir).groupBy("true_severity").agg(F.count("*").alias("n"))
    sinks.write_eval(folder, {"counts": counts})
    back = spark.read.option("header", True).csv(f"{folder}/counts")
    return back.select(F.col("true_severity").cast("int").alias("true_severity"), "n")


@query("local_replay", v.with_views(["features"], "select event_id, true_severity, hour, 'failed' as model_status from features"))
def local_replay(spark, sf_dir):
    """Raw rows end to end without a model, from Silver to the serving table."""
    from roadpulse.schemas import REPLAY_SCHEMA

    folder = shared_folder(spark, "replay")
    jobs.local_replay(spark, v.raw_replay(spark, sf_dir), folder)
    table = sinks.KeyedTable(spark, f"{folder}/serving", REPLAY_SCHEMA, "event_id", ["processed_time", "ingestion_time"])
    return table.read().select("event_id", "true_severity", "hour", "model_status")


@query(
    "profile_report",
    v.with_views(
        ["features"],
        f"""select case when event_year < {v.SPLIT_YEAR} then 'before' else 'after' end as period, event_year, count(*) as accident_count
from features group by 1, 2""",
    ),
)
def profile_report(spark, sf_dir):
    """All profile tables written to files; the one of years read back."""
    folder = shared_folder(spark, "profiles")
    jobs.profile_report(tagged(spark, sf_dir), folder, ["before", "after"])
    return spark.read.parquet(f"{folder}/years").select("period", "event_year", "accident_count")
