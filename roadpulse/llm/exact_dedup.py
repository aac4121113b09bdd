"""Exact dedup: group by a 128-bit content hash, keep one stable id, compare bytes inside groups.

Built-in functions only. Each map task first merges its own equal texts (hash aggregate on hash and text, so equal
means equal bytes and a colliding hash makes two classes); a text that makes up a third of all rows leaves each task as
one row. Texts are shuffled once, in that aggregate. Rows find their class again by narrow columns, in a join whose
large partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, without

#: Fixed by the contract: what is deleted before texts are compared.
BLANKS = r"[\x20\x09-\x0D]+"
#: The range of a 64-bit id, and the largest id.
ID_SPAN, HALF_SPAN = "18446744073709551616", "9223372036854775807"


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=content_hash) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Very long texts are hashed like any other.
    Texts are equal when identical without the blanks above; null counts as empty, and all empty texts are one group. The
    longest original (in code points) stays, then the smallest id. Rows without an id count in their group but never
    stay; a group of such rows only has a null keep_id. Repeated rows of the kept id and length all count as kept.
    """
    return _grouped(docs, id_col, text_col, hash_of).drop("digest")


def _grouped(docs: DataFrame, id_col: str, text_col: str, hash_of=content_hash) -> DataFrame:
    """The rows of ``exact_groups`` with ``digest``, a hash of the original text that tells rows of one id apart."""
    bare = F.regexp_replace("text", BLANKS, "")
    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("digest"), F.char_length("text").alias("n"), bare.alias("bare")).select(
        "doc_id", "digest", "n", "bare", hash_of(F.col("bare")).alias("hash"), F.unhex(F.sha2("bare", 256)).alias("sha"))
    # One number orders by length, then by descending id, so the aggregate keeps fixed-width buffers.
    rank = F.col("n").cast("decimal(38,0)") * F.lit(ID_SPAN).cast("decimal(20,0)") - F.col("doc_id").cast("decimal(38,0)")
    classes = rows.groupBy("hash", "bare").agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("group_size")).select(
        "hash", F.unhex(F.sha2("bare", 256)).alias("sha"), "best", "group_size")
    span = F.lit(ID_SPAN).cast("decimal(20,0)")
    classes = classes.withColumn("keep_n", F.expr(f"(best + {HALF_SPAN}BD) div {ID_SPAN}BD")).withColumn(
        "keep_id", (F.col("keep_n").cast("decimal(38,0)") * span - F.col("best")).cast("long"))
    members = rows.select("doc_id", "digest", "n", "hash", "sha")
    return members.join(classes.drop("best"), ["hash", "sha"]).select(
        "doc_id", "digest", "keep_id", "group_size",
        F.coalesce((F.col("doc_id") == F.col("keep_id")) & (F.col("n") == F.col("keep_n")), F.lit(False)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns. Rows without an id stay: nothing names them as copies.

    Rows of one id with unlike texts are judged one by one.
    """
    gone = _grouped(docs, id_col, text_col).filter(~F.col("kept") & F.col("doc_id").isNotNull()).select(F.struct("doc_id", "digest").alias("__gone"))
    return without(docs, gone, id_col, text_col)
