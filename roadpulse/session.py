"""Session defaults and the few settings the library reads from the cluster."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def build_session(app: str = "roadpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, fair pools and a fixed zone; any setting can be overridden.

    The number of shuffle partitions is left to the cluster: adaptive execution merges small ones,
    so a large value costs little and lets big shuffles fit in memory.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.scheduler.mode": "FAIR",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Fits the code generator to the wide projections of this library.

    HotSpot never compiles a method above 8,000 bytes of bytecode. The feature projection is larger
    when it is fused into one stage method, and would run interpreted, several times slower. With
    this limit Spark generates it operator by operator, in smaller methods.
    """
    spark.conf.set(METHOD_LIMIT, "8000")
    return spark


@contextmanager
def tuned(spark: SparkSession) -> Iterator[None]:
    """``tune`` for the work started inside the block, in a session that others have built; its own setting comes back."""
    before = spark.conf.get(METHOD_LIMIT, None)
    tune(spark)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(METHOD_LIMIT)
        else:
            spark.conf.set(METHOD_LIMIT, before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for data written between stages, which driver and executors share.

    It lies below ``spark.checkpoint.dir``, else below the warehouse folder; without either there is no
    place that all executors reach, and that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/roadpulse-{purpose}-{os.urandom(6).hex()}"


@contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The frame, written once and read from its files as often as needed inside the block; the files go with it.

    What is made of it must be brought out of the block before it ends.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, purpose)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
