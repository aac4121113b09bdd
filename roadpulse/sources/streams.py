"""Streaming readers and the message sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_SCHEMA


def kafka_options(topic: str, servers: str, **extra: str) -> dict[str, str]:
    """Options of the topic reader: from the earliest offset."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", **extra}


def kafka_source(spark: SparkSession, topic: str, servers: str, **extra: str) -> DataFrame:
    """Messages of a topic as text in column ``value``. Needs the connector on the class path."""
    reader = spark.readStream.format("kafka").options(**kafka_options(topic, servers, **extra))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def replay_source(
    spark: SparkSession, path: str, max_files: int = 16, schema: T.StructType | str = RAW_SCHEMA
) -> DataFrame:
    """Raw rows from a folder of JSON-lines files that grows, a bounded number of files per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def text_source(spark: SparkSession, path: str, max_files: int = 16) -> DataFrame:
    """Messages from a folder of text files, one per line, in column ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def parse_json(df: DataFrame, schema: T.StructType | str, column: str = "value") -> DataFrame:
    """Message text to columns, with the damaged message in ``_corrupt_record``."""
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
    )
    parsed = F.from_json(
        F.col(column), f"{ddl}, _corrupt_record string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    return df.withColumn("_m", parsed).select("_m.*")


def message(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows as (key, value) messages: the key column, or ``row-N`` where it is blank.

    N is a 64-bit row number that is unique but not dense: a dense one would need a global order.
    """
    fallback = F.concat(F.lit("row-"), F.monotonically_increasing_id().cast("string"))
    name: Column = F.coalesce(F.nullif(F.trim(F.col(key).cast("string")), F.lit("")), fallback)
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(name.alias("key"), value.alias("value"))


def kafka_sink(df: DataFrame, topic: str, servers: str, key: str = "event_id"):
    """Writes rows to a topic as JSON under their event id."""
    out = message(df, key)
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if df.isStreaming:
        return out.writeStream.format("kafka").options(**options)
    return out.write.format("kafka").options(**options).save()


def shard(df: DataFrame, shards: int, index: int, key: str = "ID") -> DataFrame:
    """One of ``shards`` disjoint parts of the rows, by a hash of the key: no global row number."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(shards)) == index)


def shard_by_row(df: DataFrame, shards: int, index: int, row: str, start: int = 0) -> DataFrame:
    """One part of numbered rows: numbers from ``start`` on whose remainder is ``index``."""
    return df.where((F.col(row) >= start) & (F.pmod(F.col(row), F.lit(shards)) == index))
