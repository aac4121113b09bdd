"""Training job, model store and the comparison of classifiers."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import ml
from ..operators.sampling import hash_split, stratified_cap
from ..schemas import LABEL, TRACKED_METRICS
from ..sources.files import _child_folders, folder_has
from ..sources.sinks import write_eval


_DONE = "_COMPLETE"


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Finished versions; one whose save was interrupted has no marker and does not count."""
    found = [f for f in _child_folders(spark, root) if f.startswith("version=")]
    return sorted(int(f.split("=", 1)[1]) for f in found if folder_has(spark, f"{root.rstrip('/')}/{f}", _DONE))


def save_model(model: PipelineModel, root: str) -> int:
    """Stores a model as the next version and returns its number."""
    spark = SparkSession.active()
    versions = _versions(spark, root)
    version = (versions[-1] if versions else 0) + 1
    path = f"{root.rstrip('/')}/version={version}"
    model.write().overwrite().save(path)
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_DONE}")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker).close()
    return version


def load_latest(spark: SparkSession, root: str) -> PipelineModel | None:
    """The newest stored model, or None."""
    versions = _versions(spark, root)
    return PipelineModel.load(f"{root.rstrip('/')}/version={versions[-1]}") if versions else None


def append_run(board: DataFrame, runs_path: str, run_id: str, start_time: str) -> None:
    """Adds the best model's tracked metrics to the run history."""
    metrics = [
        (F.col(c) if c in board.columns else F.lit(None).cast("double")).alias(c) for c in TRACKED_METRICS
    ]
    row = board.limit(1).select(
        F.lit(run_id).alias("run_id"), F.col("model").alias("run_name"), F.lit("FINISHED").alias("status"),
        F.lit(start_time).cast("timestamp_ntz").alias("start_time"), F.localtimestamp().alias("end_time"), *metrics,
    )
    row.write.mode("append").parquet(runs_path)


def train_job(
    rows: DataFrame, model_root: str, grid: dict[str, object] | None = None, eval_path: str | None = None,
    runs_path: str | None = None, run_id: str = "run", start_time: str = "1970-01-01 00:00:00",
    train_rows: int | None = None, test_rows: int | None = None,
) -> dict:
    """Splits, searches, evaluates, keeps the best model and stores it.

    Row limits are optional: the cluster trains on everything. With one, classes keep their shares.
    """
    labelled = rows.where(F.col(LABEL).between(1, 4))
    train_df, test_df = hash_split(labelled, "event_id", 80)
    if train_rows:
        train_df = stratified_cap(train_df, LABEL, "event_id", train_rows)
    if test_rows:
        test_df = stratified_cap(test_df, LABEL, "event_id", test_rows)
    factors = ev.class_factors(train_df, LABEL)
    board, models = ml.model_search(train_df, test_df, grid)
    ranking = board.collect()
    best = ranking[0]["model"]
    version = save_model(models[best], model_root)
    table = rows.sparkSession.createDataFrame(ranking, board.schema)
    if eval_path:
        scored = ml.score(test_df, models[best])
        report = ev.class_report(scored, LABEL, "predicted_severity")
        matrix = ev.confusion(scored, LABEL, "predicted_severity", list(ml.CLASSES))
        write_eval(eval_path, {"leaderboard": table, "class_factors": factors, "class_report": report, "confusion": matrix})
    if runs_path:
        append_run(table, runs_path, run_id, start_time)
    return {"best": best, "version": version, "metrics": json.loads(json.dumps(ranking[0].asDict()))}


def compare_classifiers(train_df: DataFrame, test_df: DataFrame, trees: int = 100, iterations: int = 1000) -> DataFrame:
    """The standard classifiers, a forest on its important features, and nearest neighbours, side by side."""
    spark = train_df.sparkSession
    fitted = {name: ml.train(train_df, e) for name, e in ml.estimators(trees, iterations).items()}
    rows = [ml.evaluate(m, test_df, name) for name, m in fitted.items()]
    forest = ml.estimators(trees)["Random Forest"]
    selected, names = ml.select_features(train_df, fitted["Random Forest"], forest)
    skipped = []
    if selected is not None:
        row = ml.evaluate(selected, test_df, "Random Forest (selected features)")
        rows.append(row.withColumn("selected_feature_count", F.lit(len(names))))
    else:
        skipped.append(("Random Forest (selected features)", "skipped", "no feature passed the threshold"))
    predicted = ml.knn(train_df, test_df, "event_id")
    scored = test_df.drop("predicted_severity").join(predicted, "event_id")
    metrics = ev.full_metrics(scored, LABEL, "predicted_severity")
    rows.append(metrics.select(F.lit("KNN (k=6)").alias("model"), F.lit("ok").alias("status"), "*"))
    table = rows[0]
    for row in rows[1:]:
        table = table.unionByName(row, allowMissingColumns=True)
    if skipped:
        notes = spark.createDataFrame(skipped, "model string, status string, skip_reason string")
        table = table.unionByName(notes, allowMissingColumns=True)
    return ev.compare_models(table)
