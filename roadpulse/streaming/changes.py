"""Stateful change detection on a stream of incident states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators.changes import state_signature

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class LastSignature(StatefulProcessor):
    """Keeps the last signature of each key; emits rows that are new or changed.

    A micro-batch may bring several states of one key, so its rows are put in time order first. Only
    the ordering columns and the signature are looked at; the row itself passes through.
    """

    def __init__(self, columns: list[str], time: str, seq: str, ttl_ms: int | None):
        self.columns, self.time, self.seq, self.ttl_ms = columns, time, seq, ttl_ms

    def init(self, handle) -> None:
        schema = T.StructType([T.StructField("signature", T.StringType())])
        self.last = handle.getValueState("last", schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timer_values):
        import pandas as pd

        batch = pd.concat(list(rows), ignore_index=True)
        # Names that start with an underscore do not survive the transfer; positions do.
        batch.columns = [*self.columns, "_sig"]
        batch = batch.sort_values([self.time, self.seq], kind="stable")
        signatures = batch["_sig"]
        first = self.last.get()[0] if self.last.exists() else None
        previous = signatures.shift(1)
        previous.iloc[0] = first
        changed = batch[signatures.ne(previous) | previous.isna()].copy()
        changed["change_status"] = [
            "new" if p is None or p != p else "update" for p in previous[changed.index]
        ]
        self.last.update((signatures.iloc[-1],))
        yield changed[[*self.columns, "change_status"]]

    def close(self) -> None:
        pass


def detect_changes(
    stream: DataFrame, key: str, time: str, seq: str, fields: list[str] | None = None, ttl_ms: int | None = None
) -> DataFrame:
    """New and changed rows of a stream, with ``change_status``. Equals the batch operator on the same rows.

    The rows of one key meet in one task, so the size of a micro-batch bounds what a task holds; set
    ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger`` on the source.
    """
    spark = stream.sparkSession
    use_state_store(spark)
    columns = stream.columns
    marked = stream.withColumn("_sig", state_signature(stream, fields))
    output = T.StructType([*stream.schema.fields, T.StructField("change_status", T.StringType())])
    processor = LastSignature(columns, time, seq, ttl_ms)
    mode = "ProcessingTime" if ttl_ms else "None"
    return marked.groupBy(F.col(key)).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode=mode
    )
