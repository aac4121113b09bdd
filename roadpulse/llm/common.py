"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that a task takes into Python objects at once.
SLICE_BYTES = 2_000_000
#: Bytes a worker may spend on results of words it has met, about.
CACHE_BYTES = 20_000_000


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, a null text as empty; all other columns go, so no name can clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Record batches cut to ``most`` bytes of text (one longer text stands alone), with the texts of one column.

    Sizes come from the Arrow column; only the texts of one slice are Python objects at a time.
    """
    for batch in batches:
        start, n = 0, batch.num_rows
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
        while start < n:
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + most, side="right")), start + 1)
            part = batch.slice(start, stop - start)
            yield part, part.column(column).to_pylist()
            start = stop


class Words(dict):
    """Results of words met before; emptied when they take more than ``share`` times ``CACHE_BYTES``, by an estimate."""

    held = 0

    def __init__(self, share: int = 1) -> None:
        self.share = share

    def make_room(self) -> bool:
        """Empties a full cache."""
        if full := self.held > self.share * CACHE_BYTES:
            self.clear()
            self.held = 0
        return full

    def unmet(self, words: Iterable) -> set:
        """The distinct words that are not held. A set's own ``difference`` walks through all of a subclass of dict."""
        return {w for w in set(words) if w not in self}

    def add(self, found: dict, each: int) -> None:
        """``each``: bytes of an entry beside its word's letters."""
        self.update(found)
        self.held += 2 * sum(map(len, found)) + each * len(found)


def release() -> None:
    """Gives free memory of a worker back at the end of a task: an idle worker stays beside the tasks of the next stage."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id and text hash are not in ``gone`` (one column ``__gone``: struct of doc_id, digest)."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    same = (docs[id_col].cast("long") == gone["__gone.doc_id"]) & (F.xxhash64(text) == gone["__gone.digest"])
    return docs.join(gone, same, "left_anti")


def map_texts(df: DataFrame, work: Callable[[list[str]], dict[str, list]], schema: str, keep: list[str]) -> DataFrame:
    """Adds the columns that ``work`` makes of a list of texts to the columns in ``keep``; one narrow pass, no shuffle.

    ``schema`` lists the kept and the new columns. ``work`` is called with bounded slices.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            made = work(texts)
            columns = [part.column(c) for c in keep] + [v if isinstance(v, pa.Array) else pa.array(v) for v in made.values()]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *made])
        release()

    return df.mapInArrow(run, schema)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that driver and executors share: below ``spark.checkpoint.dir``, else below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/llm-{purpose}-{os.urandom(6).hex()}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written as Parquet to the shared folder and read again: later steps start from files, not from lineage."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``at``, the place of a row in its ``grp`` by ``order``, and ``n``, the rows of the group; drops the columns of ``order``.

    One global sort; the rows of a group in each part of it are counted, and the counts before them give each row its place.
    """
    ordered = stored(rows.orderBy("grp", *order).withColumn("row", F.monotonically_increasing_id()), "ordered")
    part = F.shiftrightunsigned("row", 33)
    runs = ordered.groupBy("grp", part.alias("part")).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    group = Window.partitionBy("grp")
    runs = runs.select("grp", "part", "first", (F.sum("rows").over(group.orderBy("part")) - F.col("rows")).alias("earlier"), F.sum("rows").over(group).alias("n"))
    placed = ordered.withColumn("part", part).join(runs, ["grp", "part"])
    return placed.withColumn("at", F.col("earlier") + F.col("row") - F.col("first")).drop("part", "row", "first", "earlier", *order)
