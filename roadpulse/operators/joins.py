"""Joins on grouping columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on columns that may be null: a null group meets the null group. ``left``'s key columns stay."""
    other = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_of_{k}" for k in keys])
