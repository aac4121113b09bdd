"""Batch readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.features import build_features
from ..operators.keyed import missing_columns
from ..schemas import (
    FEATURE_COLUMNS,
    FEATURE_SCHEMA,
    INCIDENT_PAYLOAD,
    LABEL,
    RAW_COLUMNS,
    RAW_RENAMES,
    RAW_REQUIRED,
)

# Names that metric logs print, and the column each one fills.
LOG_METRICS = {
    "logloss": "Logloss", "mean_per_class_error": "Mean_per_class_error", "accuracy": "accuracy",
    "macro_precision": "macro_precision", "macro_recall": "macro_recall", "macro_f1": "macro_f1",
    "weighted_precision": "weighted_precision", "weighted_recall": "weighted_recall",
    "weighted_f1": "weighted_f1", "rmse": "Rmse", "mse": "Mse", "r2": "R2",
}
LOG_BEST = "Best model ID:"
LOG_BLOCK = "Evaluating model rank"
LOG_REPORT = "Per-class classification report:"
LOG_MATRIX = "Confusion matrix table:"


def spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """Some columns of a table, its rows dealt over all tasks by their values.

    A file is read in row groups, each by one task; one that was written as a single row group gives all its rows to
    a single task, and all that follows without a shuffle stays there. Only the named columns are moved.
    """
    return df.select(*columns).repartition(*columns)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Feature rows from a tree of JSON-lines files. Damaged or vanished files do not fail the read."""
    return (
        spark.read.schema(FEATURE_SCHEMA)
        .option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
        .json(path)
    )


def rename_raw(df: DataFrame) -> DataFrame:
    """Header spellings with punctuation to plain names."""
    return df.withColumnsRenamed({k: v for k, v in RAW_RENAMES.items() if k in df.columns})


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file or folder."""
    return spark.read.option("header", True).csv(path).columns


def read_raw_csv(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """Raw rows as text, under plain names; columns beyond the contract are kept.

    All files must have the header of the first one: a file that orders its columns differently is an
    error, not a silent mix-up. ``columns`` prunes the scan. A record that spans lines needs ``multi_line``, which reads each
    file as a whole in one task, so files should then be of moderate size.
    """
    fields = [T.StructField(name, T.StringType(), True) for name in csv_header(spark, path)]
    raw = (
        spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", False).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).csv(path)
    )
    renamed = rename_raw(raw)
    return renamed.select(*[c for c in columns if c in renamed.columns]) if columns else renamed


def read_incident_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per incident of landed feed documents, with the file it came from.

    A document is read as text, one per line, so a damaged one yields no incidents and fails nothing.
    """
    return incidents_of(read_payload_documents(spark, path)).select("incident", "source_file")


def read_payload_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed feed document: its incidents, or in ``damaged`` the text that could not be read.

    Folders named ``key=value`` above the files become columns, as in any partitioned source.
    """
    parsed = F.from_json(
        "value", f"{INCIDENT_PAYLOAD.strip()}, _corrupt_record string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    rows = spark.read.text(path).select("*", F.col("_metadata.file_path").alias("source_file")).withColumn("_d", parsed)
    damaged = F.when(F.col("_d").isNull(), F.col("value")).otherwise(F.col("_d._corrupt_record"))
    read = rows.withColumns({"damaged": damaged, "incidents": F.when(damaged.isNull(), F.col("_d.incidents"))})
    return read.where(F.trim("value") != "").drop("value", "_d")


def incidents_of(documents: DataFrame) -> DataFrame:
    """One row per incident of readable documents, with the columns of its document."""
    rest = [c for c in documents.columns if c not in ("incidents", "damaged")]
    return documents.where("damaged is null").select(*rest, F.explode("incidents").alias("incident"))


def _child_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders right below a path, sorted; empty when it does not exist."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def folder_has(spark: SparkSession, path: str, name: str = "_SUCCESS") -> bool:
    """Whether a folder holds a file, such as the marker of a finished write."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))


def finished_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders right below a path whose write has finished, sorted; found in one listing of their markers."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/_SUCCESS")) or []
    return sorted(s.getPath().getParent().getName() for s in found)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that a later write has replaced."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read_latest_snapshot(spark: SparkSession, root: str, fallback: str, fmt: str = "parquet") -> DataFrame:
    """The newest finished snapshot folder by name, or the fallback path when there is none.

    Only names are listed, so older snapshots are never opened; a snapshot still being written does not count.
    """
    names = finished_folders(spark, root)
    path = f"{root.rstrip('/')}/{names[-1]}" if names else fallback
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path)


def as_training(df: DataFrame) -> DataFrame:
    """Feature rows from engineered or raw input, told apart by their columns."""
    if LABEL in df.columns:
        return df
    renamed = rename_raw(df)
    missing = missing_columns(renamed, RAW_REQUIRED)
    if missing:
        raise ValueError(f"neither feature columns (no {LABEL}) nor raw columns (missing {missing})")
    return build_features(renamed)


def load_training(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Training rows from a file of either kind, with contract types."""
    if fmt != "csv":
        return as_training(spark.read.format(fmt).load(path))
    header = set(csv_header(spark, path))
    if LABEL in header:
        rows = spark.read.option("header", True).csv(path)
        types = {f.name: f.dataType for f in FEATURE_SCHEMA}
        return rows.select(
            *[F.expr(f"try_cast(`{c}` as {types[c].simpleString()})").alias(c) for c in FEATURE_COLUMNS if c in header]
        )
    return as_training(read_raw_csv(spark, path))


def read_serving(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A serving table by catalog name; an empty frame under its schema when there is none."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def path_freshness(spark: SparkSession, path: str) -> DataFrame:
    """Number of files below a path, their size, and the newest modification time.

    Only file attributes are read; the content column is never asked for.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", "modificationTime", "length")
    )
    return files.agg(
        F.count("*").alias("file_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
        F.max("modificationTime").alias("last_modified"),
    ).withColumn("status", F.when(F.col("file_count") > 0, F.lit("ok")).otherwise(F.lit("empty")))


def _log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text logs with their file and place.

    Read line by line, so a large log is cut into splits that many tasks read. A place is the byte at which
    a line's split begins, then its number among the lines of the reading task: greater for a later line of a file.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), place.alias("place"), "value").withColumnRenamed("value", "line")


def _best_block(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the evaluation block of each log's best model.

    Only the marked lines are put in order, a few per model; they give one stretch per log, and the lines in
    it are picked wherever they were read. A model id must stand in the line that opens its block.
    """
    lines = _log_lines(spark, path)
    opens, named = F.col("line").contains(LOG_BLOCK), F.col("line").contains(LOG_BEST)
    model = F.nullif(F.trim(F.regexp_extract("line", rf"{LOG_BEST}\s+(.+)$", 1)), F.lit(""))
    best = lines.where(named).select("file", "place", model.alias("model")).where("model is not null")
    best = best.groupBy("file").agg(F.min_by("model", "place").alias("model"))
    following = F.lead("place").over(Window.partitionBy("file").orderBy("place"))
    blocks = lines.where(opens).select("file", "line", F.col("place").alias("low"), following.alias("high"))
    own = blocks.join(best, "file").where(F.col("line").contains(F.col("model")))
    chosen = own.groupBy("file", "model").agg(F.min_by(F.struct("low", "high"), "low").alias("at")).select("file", "model", "at.*")
    inside = (F.col("place") >= F.col("low")) & (F.col("high").isNull() | (F.col("place") < F.col("high")))
    return lines.join(chosen, "file").where(inside).drop("low", "high")


def read_metric_log(spark: SparkSession, path: str) -> DataFrame:
    """Scalar metrics of the best model in each log; ``N/A`` and absent ones are null."""
    block = _best_block(spark, path)
    columns = []
    for name, printed in LOG_METRICS.items():
        found = F.nullif(F.regexp_extract("line", rf"{printed}:\s+([0-9.]+|N/A)", 1), F.lit(""))
        first = F.min_by(found, F.when(found.isNotNull(), F.col("place")))
        columns.append(first.try_cast("double").alias(name))
    return block.groupBy("file", "model").agg(*columns)


def read_class_log(spark: SparkSession, path: str) -> DataFrame:
    """Per-class rows of the best model's report in each log: what stands in six fields between report and matrix."""
    block = _best_block(spark, path)
    here = lambda mark: F.min(F.when(F.col("line").contains(mark), F.col("place")))
    ends = block.groupBy("file").agg(here(LOG_REPORT).alias("low"), here(LOG_MATRIX).alias("high"))
    inside = (F.col("place") > F.col("low")) & (F.col("high").isNull() | (F.col("place") < F.col("high")))
    fields = F.split(F.trim("line"), r"\s+")
    rows = block.join(ends, "file").where(inside).select("file", "model", fields.alias("of")).where(F.size("of") == 6)
    number = lambda i, kind="double": F.col("of")[i].try_cast(kind)
    table = rows.select(
        "file", "model", F.col("of")[1].alias("class_label"), number(2).alias("precision"), number(3).alias("recall"),
        number(4).alias("f1"), number(5, "bigint").alias("support"), number(0, "int").alias("_row"))
    return table.dropna(subset=["precision", "recall", "f1", "support", "_row"]).drop("_row")
