"""Merkle dataset manifest: a tree of SHA-256 digests over documents, one subtree per group, with proofs folded from midstates.

Leaves are hashed by built-in functions and ranked inside their group by one global sort: the rows a task holds of a group
are counted, and the counts before them give each row its place, so no group is ever in one task. From there a task takes
``SPAN`` consecutive nodes, whatever group they are of, and works three levels at once; the few nodes above go round again.

A parent keeps a copy of its hash state before each child slot. A proof is folded from the leaf upward by resuming the state
kept for the leaf's slot with the replaced child and the siblings right of it; what lies left of the slot is never hashed
again. Proofs and folds are made in the tasks that hold the nodes, and leave them as digests only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranked, stored

#: Children of a node, fixed by the contract; levels that a task works at once, and the nodes it takes for them.
FANOUT, LEVELS = 8, 3
SPAN = FANOUT**LEVELS
#: What a leaf covers, in order; fixed by the contract.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "grp string, at long, before array<string>, after array<string>, subroot string, root string"


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of the values: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    def field(value: Column) -> Column:
        plain = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain))

    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def levels_of(nodes: list[bytes], n: int) -> list[list[bytes]]:
    """The nodes and up to three levels above them; a single node of a group needs no parent."""
    levels = [nodes]
    for _ in range(LEVELS):
        if n == 1:
            break
        below = levels[-1]
        levels.append([hashlib.sha256(b"".join(below[i : i + FANOUT])).hexdigest().encode() for i in range(0, len(below), FANOUT)])
        n = -(-n // FANOUT)
    return levels


def midstates(level: list[bytes]) -> list:
    """For each node the state its parent had before taking it in."""
    kept = []
    for i, node in enumerate(level):
        if i % FANOUT == 0:
            state = hashlib.sha256()
        kept.append(state.copy())
        state.update(node)
    return kept


def siblings(level: list[bytes], at: int) -> tuple[bytes, bytes]:
    """The nodes left and right of one under the same parent, concatenated."""
    first = at - at % FANOUT
    return b"".join(level[first:at]), b"".join(level[at + 1 : first + FANOUT])


def spans(rows: DataFrame):
    return rows.withColumn("span", F.floor(F.col("at") / SPAN)).groupBy("grp", "span")


def in_order(rows: pa.Table, column: str) -> tuple[pa.Table, list[bytes]]:
    rows = rows.sort_by("at")
    return rows, [x.hex().encode() for x in rows[column].to_pylist()]


def tops(nodes: DataFrame) -> DataFrame:
    """(grp, at, n, node) of the nodes three levels higher, or of the group's top if that comes first."""
    def work(key, rows):
        n = rows["n"][0].as_py()
        levels = levels_of(in_order(rows, "node")[1], n)
        above = n
        for _ in levels[1:]:
            above = -(-above // FANOUT)
        return pa.table({"grp": [key[0].as_py()], "at": pa.array([key[1].as_py()], pa.int64()), "n": pa.array([above], pa.int64()),
                         "node": pa.array([bytes.fromhex(levels[-1][0].decode())], pa.binary())})

    return spans(nodes.select("grp", "at", "n", "node")).applyInArrow(work, "grp string, at long, n long, node binary")


def paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Per node its siblings left and right, level by level up to the root, given those of the nodes three levels higher."""
    def work(key, rows, up):
        rows, level = in_order(rows, "node")
        head = up.to_pylist()[0]
        levels = levels_of(level, rows["n"][0].as_py())[:-1]
        sides = [[siblings(one, i // FANOUT**k) for k, one in enumerate(levels)] for i in range(len(level))]
        return pa.table({
            "grp": rows["grp"], "at": rows["at"],
            "before": pa.array([[a.decode() for a, _ in s] + head["before"] for s in sides], pa.list_(pa.string())),
            "after": pa.array([[b.decode() for _, b in s] + head["after"] for s in sides], pa.list_(pa.string())),
            "subroot": pa.array([head["subroot"]] * len(level), pa.string()), "root": pa.array([head["root"]] * len(level), pa.string()),
        })

    return spans(nodes.select("grp", "at", "n", "node")).cogroup(above.groupBy("grp", "at")).applyInArrow(work, PATH)


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The tables of nodes from the given one up to a single node per group, each written."""
    tables = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 1
    while most > 1 or len(tables) == 1:
        tables.append(stored(tops(tables[-1]), "nodes"))
        most = -(-most // SPAN)
    return tables


def trees(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranked leaves (grp, at, n, node and more) to the paths of the nodes above them, and to (grp, rows, subroot, root)."""
    tables = climb(leaves)
    tops_of = tables[-1].select(F.col("grp").alias("name"), "node").withColumn("grp", F.lit(""))
    groups = stored(ranked(tops_of.withColumn("key", F.col("name")), ["key"]), "groups")
    over = climb(groups)
    none = F.array().cast("array<string>")
    path = over[-1].select("grp", F.lit(0).cast("long").alias("at"), none.alias("before"), none.alias("after"), F.lit("").alias("subroot"), F.lower(F.hex("node")).alias("root"))
    for level in reversed(over[:-1]):
        path = stored(paths(level, path), "paths")
    named = groups.select("grp", "at", "name", F.lower(F.hex("node")).alias("own"))
    path = path.drop("subroot").join(named, ["grp", "at"]).select(
        F.col("name").alias("grp"), F.lit(0).cast("long").alias("at"), "before", "after", F.col("own").alias("subroot"), "root")
    summary = leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("rows")).join(path.select("grp", "subroot", "root"), "grp")
    for level in reversed(tables[1:-1]):
        path = stored(paths(level, path), "paths")
    return path, summary


def hashed_rows(docs: DataFrame, altered: dict[str, Column] | None, when: Column | None, id_col: str, group_col: str, columns: Sequence[str]) -> DataFrame:
    """Ranked leaves (grp, doc_id, node, changed, at, n); ``changed`` is the digest with altered values where ``when`` holds."""
    other = leaf_digest([altered.get(c, F.col(c)) for c in columns]) if altered else F.lit(None).cast("binary")
    leaves = stored(docs.select(
        F.concat(F.when(F.col(group_col).isNull(), "-").otherwise("="), F.coalesce(F.col(group_col).cast("string"), F.lit(""))).alias("grp"),
        F.col(id_col).alias("doc_id"), leaf_digest([F.col(c) for c in columns]).alias("node"),
        (F.when(when, other) if when is not None else other).alias("changed"), F.monotonically_increasing_id().alias("line")), "leaves")
    return stored(ranked(leaves.withColumn("id", F.col("doc_id")).withColumn("digest", F.col("node")), ["id", "digest", "line"]), "ranked")


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: Sequence[str] = LEAF_COLUMNS) -> DataFrame:
    """One row per group: grp, rows, subroot, root - what is kept beside a dataset to prove it unchanged."""
    summary = trees(hashed_rows(docs, None, None, id_col, group_col, columns))[1]
    return summary.withColumn("grp", F.when(F.col("grp") != "-", F.substring("grp", 2, 2**31 - 1)))


def verify(docs: DataFrame, altered: dict[str, Column] | None = None, when: Column | None = None, id_col: str = "doc_id",
           group_col: str = "lang", columns: Sequence[str] = LEAF_COLUMNS) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves of a group ascend by id (null first), then by digest; groups ascend by their name's bytes, null first, and a null
    group is not that of the empty name. ``altered`` maps columns to changed values that hold where ``when`` does: the fold
    then starts from the changed leaf, and a change is caught as a root that differs. Rows without an id are leaves too.
    Repeated rows are leaves of their own, side by side; which of them is which makes no difference to any digest but their
    proof. A lone leaf is its subroot, with the digest of nothing as proof if it is the only group. A very long text costs one
    pass; texts are never shuffled. An empty table has no rows. Columns of other names are not read.
    """
    leaves = hashed_rows(docs, altered, when, id_col, group_col, columns)
    above = trees(leaves)[0]

    def work(key, rows, up):
        rows, level = in_order(rows, "node")
        head = up.to_pylist()[0]
        levels = levels_of(level, rows["n"][0].as_py())[:-1]
        kept = [midstates(one) for one in levels]
        higher = [(hashlib.sha256(a.encode()), b.encode(), (a + b).encode()) for a, b in zip(head["before"], head["after"])]
        folded, proofs = [], []
        for i, changed in enumerate(rows["changed"].to_pylist()):
            value, proof = level[i] if changed is None else changed.hex().encode(), hashlib.sha256()
            for k, one in enumerate(levels):
                at = i // FANOUT**k
                left, right = siblings(one, at)
                state = kept[k][at].copy()
                state.update(value + right)
                value = state.hexdigest().encode()
                proof.update(left + right)
            for before, right, both in higher:
                state = before.copy()
                state.update(value + right)
                value = state.hexdigest().encode()
                proof.update(both)
            folded.append(value.decode())
            proofs.append(proof.hexdigest())
        n = len(level)
        return pa.table({
            "doc_id": rows["doc_id"], "leaf": [x.decode() for x in level], "subroot": [head["subroot"]] * n, "root": [head["root"]] * n,
            "proof_sha256": proofs, "folded_root": folded, "verified": [x == head["root"] for x in folded]})

    kind = leaves.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return spans(leaves).cogroup(above.groupBy("grp", "at")).applyInArrow(work, out)
