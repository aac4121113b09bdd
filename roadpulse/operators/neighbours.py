"""Exact nearest neighbours of many rows among many, in tasks of bounded size.

Training rows are dealt to the cells of a k-d tree. Each row is first compared with those of its own cell; the distance of its
k-th neighbour there says which other cells can hold a nearer row, and it visits only these. Squared distances are summed
column by column, so the least sum over a cell's box, taken in the same order, never exceeds that of a row inside, also
after rounding. Of rows with equal features only the k first by key can be among the neighbours; the others are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder

#: Training rows of a cell, about, while there are fewer than ``MOST_CELLS``; rows that visit a cell in one task, about.
CELL, MOST_CELLS, VISITORS = 16_384, 2048, 16_384
#: Rows that the tree's cuts are chosen from: more or fewer change the time, not the neighbours.
CUT_ROWS = 65_536
#: Training rows of a leaf within a cell, and pairs that are compared at once.
LEAF, PAIRS = 512, 1 << 20


def stored(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def matrix(part: pa.Table | pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([part.column(c).to_numpy(zero_copy_only=False) if isinstance(part, pa.RecordBatch) else part.column(c).to_numpy() for c in names], axis=1).astype("float64", copy=False)


def least_sums(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each point and box a bound below the sums of squares to all rows in the box."""
    total = np.zeros((len(points), len(low)))
    for c in range(points.shape[1]):
        x = points[:, c, None]
        gap = np.fmax(np.fmax(low[:, c] - x, x - high[:, c]), 0.0)
        total += gap * gap
    return np.where(np.isnan(total), 0.0, total)


class Tree:
    """Cuts of a k-d tree of ``2 ** depth`` cells. Rows with a value up to the cut go left; a node without a cut sends all there."""

    def __init__(self, rows: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.column, self.cut = np.full((1 << depth) - 1, -1), np.zeros((1 << depth) - 1)
        held = [np.arange(len(rows))]
        for node in range(len(self.column)):
            own = rows[held[node]]
            right = np.zeros(len(own), dtype=bool)
            for c in np.argsort(-own.std(axis=0), kind="stable") if len(own) > 1 else ():
                values = np.sort(own[:, c])
                if values[0] < values[-1]:
                    middle = values[(len(values) - 1) // 2]
                    lower = np.searchsorted(values, middle, side="left")
                    upper = np.searchsorted(values, middle, side="right")
                    if upper == len(values) or (lower and upper + lower > len(values)):
                        middle = values[lower - 1]
                    self.column[node], self.cut[node] = c, middle
                    right = own[:, c] > middle
                    break
            held += [held[node][~right], held[node][right]]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node, at = np.zeros(len(points), dtype=np.int64), np.arange(len(points))
        for _ in range(self.depth):
            column = self.column[node]
            node = 2 * node + 1 + ((column >= 0) & (points[at, np.maximum(column, 0)] > self.cut[node]))
        return node - len(self.column)


def leaves(known: np.ndarray) -> list[np.ndarray]:
    """The places of the known rows in groups of neighbours, each in order."""
    found, todo = [], [np.arange(len(known))]
    while todo:
        own = todo.pop()
        if len(own) > LEAF:
            rows = known[own]
            spread = rows.max(axis=0) - rows.min(axis=0)
            order = np.argsort(rows[:, int(np.argmax(np.where(np.isfinite(spread), spread, 0.0)))], kind="stable")
            todo += [np.sort(own[order[: len(own) // 2]]), np.sort(own[order[len(own) // 2 :]])]
        elif len(own):
            found.append(own)
    return found


def search(points: np.ndarray, limit: np.ndarray, known: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of squares and places of the k nearest known rows of each point, nearest first, equal ones in the known rows' order.

    Where fewer qualify, the place is the number of known rows. Rows beyond ``limit`` may be left out.
    """
    sums, places = np.full((len(points), k), np.inf), np.full((len(points), k), len(known))
    groups = leaves(known)
    if not groups:
        return sums, places

    def compare(rows: np.ndarray, own: np.ndarray) -> None:
        here = known[own]
        middle = here.mean(axis=0)
        there, around = points[rows] - middle, here - middle
        sizes, lengths = (around * around).sum(axis=1), (there * there).sum(axis=1)
        # The product is off by some 5e-15 of the squared sizes, and the sum of squares by less.
        slack = 2e-12 * (np.sqrt(lengths) + np.sqrt(sizes.max())) ** 2
        rough = sizes + lengths[:, None] - 2 * (there @ around.T)
        most = np.minimum(limit[rows], sums[rows, k - 1])
        if len(own) >= k and np.isinf(most).any():
            most = np.fmin(most, np.partition(rough, k - 1, axis=1)[:, k - 1] + slack)
        # What is not finite has no rough distance and is compared.
        at, of = np.nonzero((rough <= (most + slack)[:, None]) | ~np.isfinite(rough))
        total = np.zeros(len(at))
        for c in range(points.shape[1]):
            gap = points[rows[at], c] - here[of, c]
            total += gap * gap
        real = ~np.isnan(total)
        at, of, total = at[real], of[real], total[real]
        if not len(at):
            return
        met, at = np.unique(at, return_inverse=True)
        changed = rows[met]
        of_row = np.concatenate([np.repeat(np.arange(len(met)), k), at])
        total = np.concatenate([sums[changed].ravel(), total])
        place = np.concatenate([places[changed].ravel(), own[of]])
        order = np.lexsort((place, total, of_row))
        of_row = of_row[order]
        first = order[np.arange(len(order)) - np.searchsorted(of_row, of_row) < k]
        sums[changed], places[changed] = total[first].reshape(-1, k), place[first].reshape(-1, k)

    with np.errstate(all="ignore"):
        low, high = (np.stack([f(known[own], axis=0) for own in groups]) for f in (np.min, np.max))
        for start in range(0, len(points), 4096):
            near = least_sums(points[start : start + 4096], low, high)
            home = near.argmin(axis=1)
            for first in (True, False):
                for g, own in enumerate(groups):
                    most = np.minimum(limit[start : start + 4096], sums[start : start + 4096, k - 1])
                    rows = start + np.flatnonzero(home == g if first else (home != g) & (near[:, g] <= most))
                    step = max(PAIRS // len(own), 1)
                    for i in range(0, len(rows), step):
                        compare(rows[i : i + step], own)
    return sums, places


def nearest_rows(train: DataFrame, points: DataFrame, names: list[str], k: int, cell: int = CELL, visitors: int = VISITORS) -> DataFrame:
    """``points`` (row, unique, and the features) with ``near``: total, no_key, key and label of the k nearest of ``train`` (key, label and the features).

    Nearest first; equal distances in the order of the keys, null keys last. Points that lack a feature are left out, and such
    training rows are no neighbours. They go where rows are numbers: as a filter over so many columns, the constraints
    that the optimizer derives of it would take all of the driver's memory.
    """
    spark = train.sparkSession
    order = Window.partitionBy(*names).orderBy(F.col("key").asc_nulls_last(), "label")
    train = stored(train.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank"), "fitted")
    n = train.count()
    depth = max(0, min(-(-n // cell), MOST_CELLS) - 1).bit_length()
    drawn = train.select(*names).sample(min(1.0, 1.2 * CUT_ROWS / max(n, 1)), 7).limit(CUT_ROWS).toArrow()  # a bounded number
    finite = matrix(drawn, names)
    tree = Tree(finite[np.isfinite(finite).all(axis=1)], depth)

    def placed(df: DataFrame) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = matrix(batch, names)
                whole = ~np.isnan(found).any(axis=1)
                yield batch.filter(pa.array(whole)).append_column("cell", pa.array(tree.cells(found[whole]), pa.int32()))

        return df.mapInArrow(work, df.withColumn("cell", F.lit(None).cast("int")).schema)

    cells = stored(placed(train), "cells")
    boxes = cells.groupBy("cell").agg(*[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(names) for f in (F.min, F.max)]).toPandas()  # MOST_CELLS rows
    filled = boxes["cell"].to_numpy(dtype="int64")
    low, high = (boxes[[f"{f}{i}" for i in range(len(names))]].to_numpy(dtype="float64") for f in ("min", "max"))
    key_kind = train.schema["key"].dataType.simpleString()
    near_kind = f"array<struct<total: double, no_key: boolean, key: {key_kind}, label: int>>"
    features = ", ".join(f"`{c}` double" for c in names)

    def searched(visits: DataFrame) -> DataFrame:
        """Visits (row, features, cell, most) with the nearest rows of their cell in the place of ``most``."""
        found = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}  # MOST_CELLS rows
        parts = F.get(F.array(*[F.lit(-(-found.get(c, 0) // visitors)) for c in range(1 << depth)]), F.col("cell"))
        shared = cells.where(parts > 0).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        dealt = visits.withColumn("part", F.pmod(F.xxhash64("row"), parts).cast("int"))

        def work(visit: pa.Table, known: pa.Table) -> pa.Table:
            known = known.take(pc.sort_indices(known, sort_keys=[("key", "ascending"), ("label", "ascending")], null_placement="at_end"))
            most = visit.column("most").to_numpy()
            sums, places = search(matrix(visit, names), most, matrix(known, names), k)
            real = (places < known.num_rows) & (sums <= most[:, None])
            ends = np.concatenate([[0], np.cumsum(real.sum(axis=1))])
            rows = known.select(["key", "label"]).take(pa.array(places[real])).combine_chunks()
            key, label = (rows.column(c).combine_chunks() for c in ("key", "label"))
            near = pa.StructArray.from_arrays([pa.array(sums[real]), pc.is_null(key), key, label], names=["total", "no_key", "key", "label"])
            return visit.select(["row", *names, "cell"]).append_column("near", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), near))

        both = dealt.groupBy("cell", "part").cogroup(shared.groupBy("cell", "part"))
        return both.applyInArrow(work, f"row long, {features}, cell int, near {near_kind}")

    own = stored(searched(placed(points.select("row", *names)).withColumn("most", F.lit(float("inf")))), "own-cells")

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The other cells that a row must visit."""
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                most = part.column("most").to_numpy(zero_copy_only=False)
                with np.errstate(all="ignore"):
                    near = least_sums(matrix(part, names), low, high) <= most[:, None]
                near &= filled != part.column("cell").to_numpy(zero_copy_only=False)[:, None]
                at, to = np.nonzero(near)
                for i in range(0, len(at), 8192):
                    rows = part.take(pa.array(at[i : i + 8192]))
                    yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in ("row", *names)], pa.array(filled[to[i : i + 8192]], pa.int32()), rows.column("most")],
                                                     names=["row", *names, "cell", "most"])

    known_most = F.when(F.size("near") >= k, F.get("near", k - 1)["total"]).otherwise(F.lit(float("inf")))
    visits = stored(own.withColumn("most", known_most).drop("near").mapInArrow(others, f"row long, {features}, cell int, most double"), "visits")
    more = searched(visits).where(F.size("near") > 0).groupBy("row").agg(F.flatten(F.collect_list("near")).alias("more"))
    every = F.concat("near", F.coalesce("more", F.array().cast(near_kind)))
    return own.join(more, "row", "left").select("row", *names, F.slice(F.array_sort(every), 1, k).alias("near"))
