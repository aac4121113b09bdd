"""MinHash near-dedup: circulant signatures, banding, exact check of candidates, components.

Circulant MinHash needs two permutations of a bounded universe: shingles are placed by the first, and coordinate k is the
least value of the second, shifted by k, over the set. The values of one shingle for all coordinates are therefore
neighbours in memory, and a signature is a running minimum of short stretches.

Texts with equal shingle sets are one class and are compared once. Classes that share a band are compared exactly, on full
sets, in two steps that never list all pairs of a group: first each class with the smallest class of its bands; then, in
the bands that still hold several components, only classes of different components. Groups of copies of any size cost one
comparison per class.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, id_and_text, map_texts, release, slices, stored, without
from .components import components

SHINGLE, PERCENT = 3, 85
#: 25 bands of 5: a pair at the threshold shares no band with a chance of 4 in 10 million.
BANDS, ROWS = 25, 5
COORDINATES, UNIVERSE_BITS = 128, 20
#: Candidates of the second step agree in all but so many low bits of 128 and of 1024 coordinates. With similarity J the
#: share (1 - J) / 2 of them differs; the bounds lie five standard deviations above the mean at the threshold.
FINE_COORDINATES, DEVIATIONS = 1024, 5.0
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Distinct word shingles of a text as sorted 64-bit hashes."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.words = Words()

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split()  # bytes: lowers A-Z only, splits at the six ASCII blanks
        if not words:
            return np.empty(0, dtype=np.uint64)
        known = self.words
        known.make_room()
        if fresh := known.unmet(words):
            known.add({w: xxhash.xxh3_64_intdigest(w) for w in fresh}, 200)
        ids = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        size = min(self.size, len(ids))
        total = np.full(len(ids) - size + 1, size, dtype=np.uint64) * _ODD[4]
        for i in range(size):
            total = mixed(total + ids[i : len(ids) - size + 1 + i]) * _ODD[2]
        return np.unique(total)


@lru_cache(maxsize=4)
def shingler(size: int) -> Shingler:
    return Shingler(size)


def most_bits(coordinates: int, percent: int) -> int:
    """Low bits that may differ."""
    share = (1 - percent / 100) / 2
    return math.ceil(coordinates * share + DEVIATIONS * math.sqrt(coordinates * share * (1 - share)))


@lru_cache(maxsize=2)
def permutations(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """The placing permutation, and all shifted stretches of the second one (a view, no copies)."""
    rng = np.random.default_rng(20231)
    size = 1 << UNIVERSE_BITS
    place = rng.permutation(size).astype(np.int32)
    second = rng.permutation(size).astype(np.int32)
    round_about = np.concatenate([second, second[: coordinates - 1]])
    return place, np.lib.stride_tricks.sliding_window_view(round_about, coordinates)


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """All coordinates of a non-empty set."""
    place, stretches = permutations(coordinates)
    at = place[(shingles >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
    least = stretches[at[:512]].min(axis=0)
    for i in range(512, len(at), 512):
        np.minimum(least, stretches[at[i : i + 512]].min(axis=0), out=least)
    return least


def low_bits(signatures: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, packed in 64-bit numbers."""
    return np.packbits((mixed(signatures.astype(np.uint64)) >> np.uint64(63)).astype(np.uint8), axis=1).view(np.int64)


def sketch(texts: list[str], size: int) -> dict[str, list]:
    """Per text: number of shingles, 128-bit hash of the set, packed band keys, 128 low bits of the coordinates."""
    make = shingler(size)
    counts, sets, signatures = [], [], np.zeros((len(texts), COORDINATES), dtype=np.int32)
    for i, text in enumerate(texts):
        shingles = make(text)
        counts.append(len(shingles))
        sets.append(xxhash.xxh3_128_digest(shingles.tobytes()))
        if len(shingles):
            signatures[i] = signature(shingles)
    keys = np.zeros((len(texts), BANDS), dtype=np.uint64)
    for r in range(ROWS):
        keys = mixed(keys + signatures[:, r : BANDS * ROWS : ROWS].astype(np.uint64) + _ODD[3])
    keys = mixed(keys + np.arange(BANDS, dtype=np.uint64) * _ODD[2]).view(np.int64)
    bits = low_bits(signatures)
    return {
        "n": pa.array(counts, pa.int64()), "same": pa.array(sets, pa.binary()),
        "keys": pa.array(list(keys), pa.list_(pa.int64())),
        "bits0": pa.array(bits[:, 0], pa.int64()), "bits1": pa.array(bits[:, 1], pa.int64()),
    }


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    def work(batches):
        make = shingler(size)
        last: tuple[str, np.ndarray] | None = None
        for part, lefts in slices(batches, "text_a"):
            keep = []
            for left, right in zip(lefts, part.column("text_b").to_pylist()):
                if last is None or last[0] != left:
                    last = left, make(left)
                other = make(right)
                common = len(np.intersect1d(last[1], other, assume_unique=True))
                keep.append(100 * common >= percent * (len(last[1]) + len(other) - common))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(work, "a long, b long")


def fine_bits(texts: DataFrame, size: int) -> DataFrame:
    """(rep, fine): more low bits, for the classes of the second step only."""
    names = [f"f{i}" for i in range(FINE_COORDINATES // 64)]

    def work(found: list[str]) -> dict:
        signatures = np.stack([signature(shingler(size)(t), FINE_COORDINATES) for t in found])
        bits = low_bits(signatures)
        return {"fine": pa.StructArray.from_arrays([pa.array(bits[:, i], pa.int64()) for i in range(len(names))], names=names)}

    kind = ", ".join(f"{n}: bigint" for n in names)
    return map_texts(texts, work, f"doc_id long, fine struct<{kind}>", ["doc_id"]).withColumnRenamed("doc_id", "rep")


def apart(names: list[str]) -> Column:
    """Bits that differ between the rows x and y."""
    return reduce(lambda a, b: a + b, [F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in names])


def crossing(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one band and two components that may reach the threshold by their sizes and bits; each in its first band only."""
    fine = [f"fine.f{i}" for i in range(FINE_COORDINATES // 64)]
    first_band = F.expr("array_position(zip_with(x.keys, y.keys, (a, b) -> a = b), true) = x.band + 1")
    on = ((F.col("x.key") == F.col("y.key")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.component") != F.col("y.component"))
          & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
          & (apart(["bits0", "bits1"]) <= most_bits(COORDINATES, percent)) & (apart(fine) <= most_bits(FINE_COORDINATES, percent)) & first_band)
    return rows.alias("x").join(rows.alias("y"), on).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))


def near_groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (its id is that of the component).

    Shingles are ``size`` words, words are what stands between ASCII blanks, A-Z lowered; a shorter text is one shingle.
    Null and empty texts have none and are linked with nothing. Rows without an id stay alone, with a null component and
    kept. Repeated rows are one document with two rows. Rows of one id with unlike sets go with equal sets of other ids, if
    any, and else stay alone. A very long text is a slice of its own. Classes of equal sets are told apart by 128 bits.
    """
    return _grouped(docs, size, percent, id_col, text_col).drop("digest")


def _grouped(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``near_groups`` with ``digest``, a hash of the text that tells rows of one id apart."""
    rows = id_and_text(docs, id_col, text_col)
    schema = "doc_id long, digest long, n long, same binary, keys array<long>, bits0 long, bits1 long"
    sketches = stored(map_texts(rows.withColumn("digest", F.xxhash64("text")), lambda texts: sketch(texts, size), schema, ["doc_id", "digest"]), "sketches")
    unlike = sketches.groupBy("doc_id").agg(F.min(F.xxhash64("same")).alias("low"), F.max(F.xxhash64("same")).alias("high")).filter("low < high")
    classes = sketches.filter("n > 0 and doc_id is not null").join(unlike, "doc_id", "left_anti").groupBy("same", "n", "keys", "bits0", "bits1").agg(F.min("doc_id").alias("rep"))
    banded = classes.select("rep", "n", "bits0", "bits1", F.posexplode("keys").alias("band", "key"))

    shared = banded.groupBy("key").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("in_band")).filter("in_band > 1").drop("in_band")
    members = stored(banded.join(shared, "key"), "bands")
    heads = members.filter("rep = a").select("key", F.col("n").alias("n_a"))
    sized = F.least("n", "n_a") * 100 >= F.greatest("n", "n_a") * percent
    first = members.filter("rep > a").join(heads, "key").filter(sized).groupBy(F.col("rep").alias("b")).agg(F.min("a").alias("a"))
    texts = stored(rows.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), "texts")
    links = stored(confirmed(first.select("a", "b"), texts, size, percent), "links")
    found = components(links)

    # Bands that still hold several components: only classes of different components are compared. The finer bits,
    # and the rule that a pair counts in its first band only, come before any pair is made.
    placed = members.join(found.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_bands = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_bands = open_bands.filter("low < high").select("key")
    placed = stored(placed.join(open_bands, "key").select("key", "band", "rep", "n", "bits0", "bits1", "component"), "open")
    fine = fine_bits(texts.join(placed.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), size)
    placed = stored(placed.join(fine, "rep").join(classes.select("rep", "keys"), "rep"), "crossing")
    second = crossing(placed, percent).distinct().join(first, ["a", "b"], "left_anti")
    more = stored(confirmed(stored(second, "pairs"), texts, size, percent), "links")
    if not more.isEmpty():
        found = components(links.union(more))

    of_class = classes.select("same", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "same", F.coalesce("component", "rep").alias("component"))
    placed_rows = sketches.filter("n > 0").join(of_class, "same", "left").select(
        "doc_id", "digest", "n", F.coalesce("component", "doc_id").alias("component"))
    alone = sketches.filter("n = 0").select("doc_id", "digest", "n", F.col("doc_id").alias("component"))
    every = placed_rows.union(alone).withColumn("component", F.when(F.col("doc_id").isNotNull(), F.col("component")))
    return every.select("doc_id", "digest", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one of each group, with all their columns. Rows of one id with unlike texts are judged one by one."""
    gone = _grouped(docs, size, percent, id_col, text_col).filter("not kept").select(F.struct("doc_id", "digest").alias("__gone"))
    return without(docs, gone, id_col, text_col)
