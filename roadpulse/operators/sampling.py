"""Repeatable splits and samples, ordered by a hash of the row's key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_groups

BUCKETS = 1 << 16


def key_hash(key: str, seed: str = "") -> Column:
    """32-bit hash of a text key as bigint; other engines can compute the same number."""
    text = F.col(key).cast("string") if not seed else F.concat(F.lit(seed), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def hash_split(df: DataFrame, key: str, train_percent: int = 80, seed: str = "") -> tuple[DataFrame, DataFrame]:
    """Train and test rows. A key always falls on the same side, whatever else the table holds."""
    part = F.pmod(key_hash(key, seed), F.lit(100))
    return df.where(part < train_percent), df.where(part >= train_percent)


def temporal_split(df: DataFrame, year: int, column: str = "event_year") -> tuple[DataFrame, DataFrame]:
    """Rows before a year, and from it on."""
    return df.where(F.col(column) < year), df.where(F.col(column) >= year)


def first_by_hash(df: DataFrame, group: str, key: str, quota: DataFrame, seed: str = "") -> DataFrame:
    """The first rows of each group in hash order, as many as ``quota`` (group, quota) grants.

    A group may hold most of the table, so no task sorts one. Rows are counted by the upper half of
    their hash; running counts over these 65,536 buckets show in which bucket the quota is used up.
    Rows of earlier buckets all stay, and only that one bucket is put in order.
    ``quota`` has one row per group; a null group is a group like any other.
    """
    hashed = df.withColumn("_h", key_hash(key, seed)).withColumn("_b", F.shiftright("_h", 16).cast("int"))
    counts = hashed.groupBy(group, "_b").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(group).orderBy("_b")
    running = join_groups(counts.withColumn("_upto", F.sum("_n").over(upto)), quota, [group])
    # The bucket that uses up the quota, or none when the group has no more rows than that.
    cuts = running.groupBy(group).agg(
        F.min(F.when(F.col("_upto") >= F.col("quota"), F.col("_b"))).alias("_cut"),
        F.max(F.when(F.col("_upto") < F.col("quota"), F.col("_upto"))).alias("_before"), F.max("quota").alias("_quota"),
    )
    placed = join_groups(hashed, cuts, [group])
    whole = placed.where(F.col("_cut").isNull() | (F.col("_b") < F.col("_cut")))
    order = Window.partitionBy(group).orderBy("_h", key)
    last = placed.where(F.col("_b") == F.col("_cut")).withColumn("_rank", F.row_number().over(order))
    last = last.where(F.col("_rank") <= F.col("_quota") - F.coalesce("_before", F.lit(0)))
    return whole.select(*df.columns).unionByName(last.select(*df.columns))


def sample_per_group(df: DataFrame, group: str, key: str, rows: int = 50_000, seed: str = "") -> DataFrame:
    """At most ``rows`` rows of each group, chosen by hash."""
    quota = df.groupBy(group).agg(F.lit(rows).cast("bigint").alias("quota"))
    return first_by_hash(df, group, key, quota, seed)


def class_quota(df: DataFrame, label: str, total: int) -> DataFrame:
    """How many of ``total`` rows each class gets: its share, leftovers by largest remainder.

    All rows when there are no more than ``total``. Works on one row per class.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    everything = F.sum("n").over(Window.partitionBy())
    exact = F.col("n") * F.lit(float(total)) / everything
    shares = counts.select(label, "n", everything.alias("all"), F.floor(exact).alias("base"), (exact - F.floor(exact)).alias("rest"))
    leftover = F.lit(total) - F.sum("base").over(Window.partitionBy())
    rank = F.row_number().over(Window.partitionBy().orderBy(F.round("rest", 9).desc(), F.col(label)))
    quota = F.when(F.col("all") <= total, F.col("n")).otherwise(F.col("base") + (rank <= leftover).cast("bigint"))
    return shares.select(label, quota.cast("bigint").alias("quota"))


def stratified_cap(df: DataFrame, label: str, key: str, total: int, seed: str = "") -> DataFrame:
    """At most ``total`` rows with the classes in their original proportions, chosen by hash."""
    rows = df.where(F.col(label).isNotNull())
    return first_by_hash(rows, label, key, class_quota(rows, label, total), seed)
