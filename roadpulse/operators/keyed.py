"""Rows by key: latest row, upsert, update, schema alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALWAYS_NEW = ("updated_at",)


def latest_per_key(df: DataFrame, key: str | list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by`` (nulls lowest), remaining ties by the other columns.

    Rows are ranked where they lie, by their own columns; Spark cuts each task to one row per key before the
    shuffle, so a key that holds a large part of the table never becomes one large group.
    """
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order_by, *rest]]))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_timestamp(df: DataFrame, column: str = "event_time") -> DataFrame:
    """Latest value of a time column, as a one-row frame."""
    return df.agg(F.max(column).alias("latest_time"))


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows under a table's schema: missing columns become null, types are cast, order is fixed."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def missing_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    """Wanted columns that a frame lacks, in order."""
    return [c for c in wanted if c not in set(df.columns)]


def upsert(
    table: DataFrame, batch: DataFrame, key: str, order_by: list[str], now=None
) -> DataFrame:
    """Table after a batch: every column of a known key is replaced, ``created_at`` is kept.

    Inside the batch the latest row of a key wins; the batch as a whole wins over the table.
    ``now`` stamps ``updated_at`` and, for new keys, ``created_at``. Both sides have one row per key
    here, so one pass over their union replaces the two shuffles of an anti join plus union.
    """
    stamp = (F.lit(now) if now is not None else F.localtimestamp()).cast("timestamp_ntz")
    fresh = latest_per_key(batch, key, order_by)
    fresh = fresh.withColumns({"updated_at": stamp, "created_at": stamp})
    fresh = align_schema(fresh, table.schema)
    both = table.withColumn("_generation", F.lit(0)).unionByName(fresh.withColumn("_generation", F.lit(1)))
    # Two rows per key at most: the new one, and the old one next to it, which lends its creation time.
    versions = Window.partitionBy(key).orderBy(F.col("_generation").desc())
    ranked = both.withColumns({"_rank": F.row_number().over(versions), "_created": F.lead("created_at").over(versions)})
    created = F.coalesce("_created", "created_at")
    return ranked.where("_rank = 1").select(*[created.alias(c) if c == "created_at" else F.col(c) for c in table.columns])


def update_from(table: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Table with some columns replaced where the updates have the key; other rows stay as they are."""
    new = updates.select(key, F.struct(*columns).alias("_new"))
    joined = table.join(new, key, "left")
    value = lambda c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c))
    return joined.select(*[value(c).alias(c) if c in columns else F.col(c) for c in table.columns])
