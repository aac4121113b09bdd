"""Writers: Silver, Gold, training files, evaluation tables, keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.features import build_features, to_contract
from ..operators.keyed import align_schema, latest_per_key
from ..schemas import FEATURE_COLUMNS
from .files import finished_folders, remove_folder

UNKNOWN_DATE = "unknown_date"


def with_event_date(df: DataFrame) -> DataFrame:
    """Adds the partition column ``event_date``; rows without time go to ``unknown_date``."""
    day = F.substring(F.col("event_time").cast("string"), 1, 10)
    return df.withColumn("event_date", F.coalesce(F.nullif(day, F.lit("")), F.lit(UNKNOWN_DATE)))


def write_silver(df: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Feature rows as JSON lines by event date.

    With a batch id the rows go to that batch's own folder, replaced as a whole, so a micro-batch that
    is run again leaves the same files.
    """
    target = path if batch_id is None else f"{path.rstrip('/')}/batch_id={batch_id}"
    rows = with_event_date(to_contract(df))
    mode = "append" if batch_id is None else "overwrite"
    # Brings a date's rows together, so that not every task writes a file per date; adaptive execution
    # splits a date that is too large for one task and merges small ones.
    rows = rows.hint("rebalance", "event_date")
    rows.write.mode(mode).partitionBy("event_date").json(target)


def write_gold_parquet(df: DataFrame, path: str, dynamic: bool = False) -> None:
    """Gold rows as Parquet by year. Replaces all, or with ``dynamic`` only the years present.

    A year's rows are brought together; adaptive execution splits a year that is too large for one task.
    """
    mode = "dynamic" if dynamic else "static"
    writer = df.hint("rebalance", "event_year").write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy("event_year").parquet(path)


def write_gold_csv(df: DataFrame, path: str) -> None:
    """Gold rows as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_training(raw: DataFrame, path: str) -> dict[str, int]:
    """Raw rows as a training CSV with the contract's columns; returns how many were read, written, skipped.

    The counts ride along with the write; the input is read once.
    """
    seen, kept = Observation("read"), Observation("written")
    observed = raw.observe(seen, F.count(F.lit(1)).alias("n"))
    rows = to_contract(build_features(observed)).select(*FEATURE_COLUMNS)
    rows.observe(kept, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("header", True).csv(path)
    processed, written = seen.get["n"], kept.get["n"]
    return {"processed": processed, "written": written, "skipped": processed - written}


def write_eval(path: str, tables: dict[str, DataFrame], fmt: str = "csv") -> None:
    """Evaluation tables, one folder per name. Arrays are not allowed in CSV; write those as Parquet."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        writer = writer.option("header", True) if fmt == "csv" else writer
        writer.format(fmt).save(f"{path.rstrip('/')}/{name}")


def split_by_year(df: DataFrame, year: int, time_column: str = "Start_Time") -> DataFrame:
    """Raw rows with ``event_year`` and the side of the split they fall on: train, pipeline or invalid."""
    from ..functions.clean import parse_event_time

    side = (
        F.when(F.col("event_year").isNull(), F.lit("invalid")).when(F.col("event_year") < year, F.lit("train"))
        .otherwise(F.lit("pipeline"))
    )
    return df.withColumn("event_year", F.year(parse_event_time(F.col(time_column)))).withColumn("side", side)


def write_split(df: DataFrame, path: str, year: int) -> dict[str, int]:
    """Writes both sides of a split by year as CSV in one pass; returns row counts, invalid ones included.

    The side is the partition column of a single write, so the input is parsed once.
    """
    counts = Observation("split")
    sides = split_by_year(df, year).observe(
        counts,
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("side") == s).alias(s) for s in ("train", "pipeline", "invalid")],
    )
    valid = sides.where(F.col("side") != "invalid").drop("event_year")
    valid.write.mode("overwrite").option("header", True).partitionBy("side").csv(path)
    return dict(counts.get)


class KeyedTable:
    """A Parquet table with one visible row per key, fed by batches.

    ``upsert`` only writes the batch, to a folder of its own, replaced when the batch is run again:
    its cost does not depend on the table. ``read`` shows the latest row of each key, batches later
    than the last compaction over the compacted rows. ``compact`` writes the visible rows as a new
    base; a base counts only once its write has finished, so a lost job leaves the table readable.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, order_by: list[str]):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.order_by = key, order_by
        self._stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])

    def upsert(self, batch: DataFrame, batch_id: int, now=None) -> None:
        """Adds a batch; inside it the latest row of a key wins."""
        stamp = (F.lit(now) if now is not None else F.localtimestamp()).cast("timestamp_ntz")
        rows = latest_per_key(batch, self.key, self.order_by)
        rows = align_schema(rows.withColumns({"updated_at": stamp, "created_at": stamp}), self.schema)
        rows.write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")

    def _numbers(self, kind: str) -> list[int]:
        return sorted(int(f.split("=", 1)[1]) for f in finished_folders(self.spark, f"{self.path}/{kind}") if "=" in f)

    def batch_numbers(self) -> list[int]:
        """Numbers of the batches whose write has finished and that no compaction has removed."""
        return self._numbers("batches")

    def written(self) -> DataFrame:
        """The rows of those batches as they were written, several to a key that came in several batches."""
        numbers = self.batch_numbers()
        return self._read("batches", "batch_id", numbers) if numbers else self.spark.createDataFrame([], self._stored)

    def exists(self) -> bool:
        return bool(self._numbers("batches") or self._numbers("base"))

    def _read(self, kind: str, name: str, numbers: list[int]) -> DataFrame:
        paths = [f"{self.path}/{kind}/{name}={n}" for n in numbers]
        base = f"{self.path}/{kind}"
        rows = self.spark.read.schema(self._stored if name == "batch_id" else self.schema)
        return rows.option("basePath", base).parquet(*paths)

    def read(self) -> DataFrame:
        """The visible rows. ``created_at`` is that of a key's first batch."""
        bases, batches = self._numbers("base"), self._numbers("batches")
        upto = bases[-1] if bases else None
        parts = []
        if upto is not None:
            parts.append(self._read("base", "upto", [upto]).select("*", F.lit(-1).cast("bigint").alias("batch_id")))
        later = [n for n in batches if upto is None or n > upto]
        if later:
            parts.append(self._read("batches", "batch_id", later))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        if len(parts) == 1 and len(later) <= 1:
            # A base or a single batch has one row per key already.
            return parts[0].drop("batch_id")
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        # Each batch has one row per key: the last one counts, the first one lends its creation time.
        first = F.first("created_at").over(Window.partitionBy(self.key).orderBy("batch_id"))
        last = F.row_number().over(Window.partitionBy(self.key).orderBy(F.col("batch_id").desc()))
        ranked = rows.withColumns({"_first": first, "_rank": last}).where("_rank = 1")
        return ranked.select(*[F.col("_first" if f.name == "created_at" else f.name).alias(f.name) for f in self.schema.fields])

    def compact(self) -> None:
        """Writes the visible rows as a new base, so that reads need not look at older batches."""
        batches = self._numbers("batches")
        if batches:
            self.read().write.mode("overwrite").parquet(f"{self.path}/base/upto={batches[-1]}")
            self._drop_replaced(batches[-1])

    def compact_beyond(self, batches: int) -> None:
        """Compacts when more than ``batches`` batches lie above the base, so that reads stay bounded."""
        bases = self._numbers("base")
        if sum(1 for n in self._numbers("batches") if not bases or n > bases[-1]) > batches:
            self.compact()

    def _drop_replaced(self, upto: int) -> None:
        """Removes bases and batches older than the base before this one; readers of that one still find all its files."""
        bases = [n for n in self._numbers("base") if n < upto]
        if bases:
            for n in bases[:-1]:
                remove_folder(self.spark, f"{self.path}/base/upto={n}")
            for n in self._numbers("batches"):
                if n <= bases[-1]:
                    remove_folder(self.spark, f"{self.path}/batches/batch_id={n}")
