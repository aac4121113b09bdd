"""Suffix-array dedup: bytes covered by a string that an earlier document also holds are removed.

1. Every window of ``LENGTH`` bytes has an anchor, the leftmost of its smallest 16-byte hashes; equal windows have equal
   anchors at equal places. The windows of one anchor, a run, cover a short stretch of text. Tasks pack the hashes of their
   anchors and runs in a few buckets; entries that a task can already settle (the same run in an earlier document) are
   marked as copies there, so copies of any number leave a task as one entry and short marks.
2. A bucket finds for every anchor its distinct runs and the earliest document of each. The same run in a later document
   is a copy; where an anchor has several runs, they may share some of their windows only, and are sorted.
3. The texts of those runs are sorted as suffixes, one suffix bucket at a time: by their first ``PERIOD`` bytes, longer
   ties by the ranks of a difference-cover sample of the positions, computed before. Neighbours that share ``LENGTH``
   bytes form groups, whose earliest document keeps the string.
4. Each document joins its marks and is cut.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text

LENGTH, GRAM = 50, 16
SPAN = LENGTH - GRAM + 1
#: Difference cover of PERIOD: any two residues differ as two members do.
PERIOD, COVER = 21, np.array([0, 1, 4, 14, 16])
#: Bytes of text a task sketches, or sorts, at once; suffixes sorted at once.
SLICE_BYTES, SORT_BYTES, SORT_SUFFIXES = 8_000_000, 1_500_000, 1 << 18
BUCKET_BYTES = 24_000_000
COPY, SORT = 0, 1
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def windows_hashed(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every stretch of ``size`` bytes, from those of two stretches that cover it."""
    h, n, step = data.astype(np.uint64) + _M[5], 1, 0
    while n < size:
        by = min(n, size - n)
        h = (h[:-by] * _M[step % 5]) ^ (h[by:] + (h[by:] << np.uint64(7)))
        h ^= h >> np.uint64(31)
        n, step = n + by, step + 1
    return h * _M[1]


def runs_of(data: np.ndarray, grams: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, place of the anchor, first window, number of windows) of the runs of one text, in order."""
    if len(data) < LENGTH:
        empty = np.empty(0, dtype=np.int64)
        return empty.view(np.uint64), empty, empty, empty
    grams = windows_hashed(data, GRAM) if grams is None else grams
    least, n = grams, 1
    while n < SPAN:
        by = min(n, SPAN - n)
        least = np.minimum(least[:-by], least[by:])
        n += by
    # Where the smallest hash stays the same from window to window, it is one place, or equal ones in a row.
    starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    firsts, places = [], []
    for lo in range(0, len(starts), 4096):
        begin = starts[lo : lo + 4096]
        end = np.append(starts, len(least))[lo + 1 : lo + 1 + len(begin)]
        at = begin.copy()
        live = np.ones(len(begin), dtype=bool)
        while live.any():  # the leftmost equal hash at or after the window's start
            i = np.flatnonzero(live)
            stretch = grams[np.minimum(at[i][:, None] + np.arange(SPAN), len(grams) - 1)]
            place = at[i] + (stretch == least[at[i]][:, None]).argmax(axis=1)
            firsts.append(at[i].copy())
            places.append(place)
            at[i] = place + 1  # windows beyond the place start a run of the next equal hash
            live[i] = at[i] < end[i]
    first, place = np.concatenate(firsts), np.concatenate(places)
    order = np.argsort(first, kind="stable")
    first, place = first[order], place[order]
    count = np.diff(np.append(first, len(least)))
    return grams[place], place, first, count


def run_hashes(grams: np.ndarray, place: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """64-bit hash of the text of each run, and of where its anchor lies in it."""
    def window(at: np.ndarray) -> np.ndarray:
        """Hash of LENGTH bytes, from those of the stretches that cover them."""
        out = grams[at]
        for k, lo in enumerate([*range(GRAM, LENGTH - GRAM, GRAM), LENGTH - GRAM]):
            out = (out * _M[k % 5]) ^ grams[at + lo]
            out ^= out >> np.uint64(31)
        return out

    # The first and the last window cover a run: it has no more than SPAN windows.
    out = window(first) * _M[0] ^ window(first + count - 1)
    out = (out ^ (out >> np.uint64(29))) * _M[2] + (place - first).astype(np.uint64) * _M[3] + count.astype(np.uint64) * _M[4]
    return (out ^ (out >> np.uint64(32))) * _M[1]


def planes(values: np.ndarray) -> bytes:
    """The bytes of numbers, highest bytes of all first, so that equal high bytes compress."""
    if not len(values):
        return b""
    return values.astype(values.dtype.newbyteorder(">")).view(np.uint8).reshape(len(values), -1).T.tobytes()


def unplaned(raw: bytes, kind: str, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    if not n:
        return np.empty(0, dtype=kind)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(np.dtype(kind).newbyteorder(">")).ravel().astype(kind)


def sketch_slice(ids: list[int], texts: list[bytes], buckets: int) -> list[tuple[int, bytes, bytes, bytes, bytes, int, bytes, bytes, int]]:
    """Per bucket: packed entries (anchor, run, document, number of the run in it) and packed copies (document, number)."""
    anchors, runs, docs, numbers = [], [], [], []
    for doc, raw in zip(ids, texts):
        if len(raw) >= LENGTH:
            data = np.frombuffer(raw, np.uint8)
            grams = windows_hashed(data, GRAM)
            a, place, first, count = runs_of(data, grams)
            anchors.append(a)
            runs.append(run_hashes(grams, place, first, count))
            docs.append(np.full(len(a), doc, dtype=np.int64))
            numbers.append(np.arange(len(a), dtype=np.int32))
    if not anchors:
        return []
    a, r, d, i = map(np.concatenate, (anchors, runs, docs, numbers))
    order = np.lexsort((i, d, r, a))
    a, r, d, i = a[order], r[order], d[order], i[order]
    opens = np.ones(len(a), dtype=bool)
    opens[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
    copy = d > d[np.maximum.accumulate(np.where(opens, np.arange(len(a)), 0))]
    bucket = (a % np.uint64(buckets)).astype(np.int64)
    out = []
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        of = order[cuts[b] : cuts[b + 1]]
        if len(of):
            own, done = of[~copy[of]], of[copy[of]]
            out.append((b, planes(a[own]), planes(r[own]), planes(d[own]), planes(i[own]), len(own), planes(d[done]), planes(i[done]), len(done)))
    return out


def settle_bucket(a: np.ndarray, r: np.ndarray, d: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, number of the run, COPY or SORT) for the entries of one bucket that need a mark."""
    order = np.lexsort((i, d, r, a))
    a, r, d, i = a[order], r[order], d[order], i[order]
    new_anchor = np.ones(len(a), dtype=bool)
    new_anchor[1:] = a[1:] != a[:-1]
    new_run = new_anchor.copy()
    new_run[1:] |= r[1:] != r[:-1]
    earliest = d[np.maximum.accumulate(np.where(new_run, np.arange(len(a)), 0))]
    anchor = np.cumsum(new_anchor) - 1
    several = np.bincount(anchor, weights=new_run) > 1
    low = np.full(len(several), np.iinfo(np.int64).max)
    high = np.full(len(several), np.iinfo(np.int64).min)
    np.minimum.at(low, anchor, earliest)
    np.maximum.at(high, anchor, earliest)
    # Runs of one document only have no earlier document to lose a window to.
    several &= low < high
    copy = d > earliest
    sort = ~copy & several[anchor]
    marked = copy | sort
    return d[marked], i[marked], np.where(sort, SORT, COPY)[marked]


def words_of(text: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as a number that orders as the bytes do."""
    out = np.zeros(len(text) - 7, dtype=np.uint64)
    for b in range(8):
        out <<= np.uint64(8)
        out |= text[b : len(text) - 7 + b]
    return out


def words_at(words: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    """The ``size`` bytes at each place as numbers."""
    return [
        words[at + lo] if lo + 8 <= size else words[at + lo] >> np.uint64(8 * (lo + 8 - size)) for lo in range(0, size, 8)
    ]


def names(keys: list[np.ndarray]) -> np.ndarray:
    """Rank of each row of keys, equal rows equal ranks; the first key counts most."""
    order = np.lexsort(keys[::-1])
    step = np.zeros(len(order), dtype=np.int64)
    for k in keys:
        step[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(step)
    return out


def cover_ranks(text: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Ranks of the positions of the difference-cover sample among themselves, 0 elsewhere; by doubling steps of PERIOD."""
    last = len(words) - PERIOD
    sample = (np.arange(0, last, PERIOD)[:, None] + COVER).ravel()
    sample = sample[sample < last]
    rank = np.zeros(len(text) + LENGTH + 2 * PERIOD, dtype=np.int64)
    rank[sample] = names(words_at(words, sample, PERIOD)) + 1
    reach = PERIOD
    while reach < LENGTH:  # ranks by LENGTH bytes tell apart what counts here
        rank[sample] = names([rank[sample], rank[np.minimum(sample + reach, len(rank) - 1)]]) + 1
        reach *= 2
    return rank


def equal_windows(text: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Group number of each suffix; equal numbers where the first LENGTH bytes are equal.

    The suffixes are sorted one bucket of leading bytes at a time. ``text`` ends in LENGTH + PERIOD spare bytes.
    """
    words = words_of(text)
    rank = cover_ranks(text, words)
    shift = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])
    lead = words[suffixes]
    groups = np.empty(len(suffixes), dtype=np.int64)
    spread = np.sort(lead[:: max(1, len(lead) // 4096)])
    parts = max(1, -(-len(suffixes) // SORT_SUFFIXES))
    splitters = np.unique(spread[np.linspace(0, len(spread) - 1, parts + 1).astype(int)[1:-1]]) if parts > 1 else spread[:0]
    bucket = np.searchsorted(splitters, lead, side="right")
    given = 0
    for b in range(len(splitters) + 1):
        of = np.flatnonzero(bucket == b)
        if not len(of):
            continue
        at = suffixes[of]
        residue = at % PERIOD
        keys = [*words_at(words, at, PERIOD), residue, rank[at + shift[residue]]]
        order = np.lexsort(keys[::-1])
        ordered = at[order]
        differs = np.ones(len(of), dtype=np.int64)
        differs[1:] = 0
        for w in words_at(words, ordered, LENGTH):
            differs[1:] |= w[1:] != w[:-1]
        groups[of[order]] = np.cumsum(differs) - 1 + given
        given += int(differs.sum())
    return groups


def shared_windows(texts: list[bytes], anchor_at: np.ndarray, docs: np.ndarray) -> list[bytes]:
    """Per run: a byte for each of its windows, 1 where an earlier document of the given ones holds the window too."""
    counts = np.array([len(t) - LENGTH + 1 for t in texts], dtype=np.int64)
    # Anchors stand at multiples of PERIOD, so equal windows have equal residues and one shift to the cover serves both.
    begins, at = np.empty(len(texts), dtype=np.int64), 0
    for k, t in enumerate(texts):
        at += (-(at + int(anchor_at[k]))) % PERIOD
        begins[k] = at
        at += len(t)
    text = np.zeros(at + LENGTH + 2 * PERIOD + 8, dtype=np.uint8)
    for b, t in zip(begins.tolist(), texts):
        text[b : b + len(t)] = np.frombuffer(t, np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    suffixes = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + begins[owner]
    groups = equal_windows(text, suffixes)
    earliest = np.full(int(groups.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(earliest, groups, docs[owner])
    lost = (earliest[groups] < docs[owner]).astype(np.uint8)
    return [x.tobytes() for x in np.split(lost, np.cumsum(counts)[:-1])]


class Cut:
    """The bytes of one document that go."""

    def __init__(self, size: int) -> None:
        self.edges = np.zeros(size + 1, dtype=np.int32)

    def windows(self, first: np.ndarray, last: np.ndarray) -> None:
        """Windows from ``first`` to ``last`` go."""
        np.add.at(self.edges, first, 1)
        np.add.at(self.edges, last + LENGTH, -1)

    def result(self, raw: bytes) -> tuple[int, int, int, bytes]:
        gone = np.cumsum(self.edges[:-1]) > 0
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[:1].sum())
        return len(raw), int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _result_batch(rows: list[tuple[int, tuple[int, int, int, bytes]]], keep_bytes: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([d for d, _ in rows], pa.int64()), pa.array([x[0] for _, x in rows], pa.int64()), pa.array([x[1] for _, x in rows], pa.int64()),
        pa.array([x[2] for _, x in rows], pa.int64()), pa.array([x[3] if keep_bytes else None for _, x in rows], pa.binary()),
        pa.array([hashlib.sha256(x[3]).hexdigest() for _, x in rows], pa.string()),
    ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])


def _byte_slices(batches, *columns: str):
    """Lists of the given columns, the first a text, in slices of bounded bytes."""
    held: list[list] = [[] for _ in columns]
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            raw = row[0].encode("utf-8", "replace") if isinstance(row[0], str) else row[0]
            if size and size + len(raw) > SLICE_BYTES:
                yield held
                held, size = [[] for _ in columns], 0
            for h, v in zip(held, (raw, *row[1:])):
                h.append(v)
            size += len(raw)
    if held[0]:
        yield held


def _bulk(data: np.ndarray, codes: list[int]):
    """The cut with the copied runs of a document, the numbers of those to be sorted, and its runs."""
    _, place, first, count = runs_of(data)
    cut = Cut(len(data))
    codes = np.array(codes, dtype=np.int64)
    codes = codes[codes >> 1 < len(first)]
    number, kind = codes >> 1, codes & 1
    of = number[kind == COPY]
    cut.windows(first[of], first[of] + count[of] - 1)
    return cut, np.unique(number[kind == SORT]), place, first, count


def remove_repeats(docs: DataFrame, keep_bytes: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay, if asked for), kept_sha256.

    A byte goes when a string of LENGTH bytes over it also starts in a document with a smaller id, judged on the input. Null
    text counts as empty. Rows without an id lose nothing and take nothing. Repeated rows give repeated results; an id is meant to
    name one text, and where it names several, each is cut by the marks of all of them that fit it.
    """
    rows = id_and_text(docs, id_col, text_col)
    bytes_in = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(12, -(-bytes_in // BUCKET_BYTES))

    def sketched(batches):
        for raws, ids in _byte_slices(batches, "text", "doc_id"):
            out = sketch_slice(ids, raws, buckets)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["b", "a", "r", "d", "i", "n", "cd", "ci", "cn"])

    def settled(table: pa.Table) -> pa.Table:
        at = {c: table.column(c).to_pylist() for c in ("a", "r", "d", "i", "n", "cd", "ci", "cn")}
        entries = [np.concatenate([unplaned(raw, kind, n) for raw, n in zip(at[c], at["n"])]) for c, kind in (("a", "u8"), ("r", "u8"), ("d", "i8"), ("i", "i4"))]
        d, i, kind = settle_bucket(*entries)
        cd, ci = (np.concatenate([unplaned(raw, k, n) for raw, n in zip(at[c], at["cn"])]) for c, k in (("cd", "i8"), ("ci", "i4")))
        return pa.table({"doc_id": np.concatenate([d, cd]), "code": np.concatenate([i.astype(np.int64) * 2 + kind, ci.astype(np.int64) * 2 + COPY])})

    named = rows.filter("doc_id is not null")
    sketches = named.filter(F.octet_length("text") >= LENGTH).mapInArrow(
        sketched, "b long, a binary, r binary, d binary, i binary, n long, cd binary, ci binary, cn long")
    codes = sketches.groupBy("b").applyInArrow(settled, "doc_id long, code long").groupBy("doc_id").agg(F.collect_list("code").alias("codes"))
    joined = named.join(codes, "doc_id", "left").select("doc_id", "text", F.coalesce("codes", F.array().cast("array<bigint>")).alias("codes"))

    def finished(batches):
        for raws, ids, marks in _byte_slices(batches, "text", "doc_id", "codes"):
            out = []
            for raw, doc, codes_of in zip(raws, ids, marks):
                cut, sort, *_ = _bulk(np.frombuffer(raw, np.uint8), codes_of) if codes_of else (Cut(len(raw)), ())
                if not len(sort):
                    out.append((doc, cut.result(raw)))
            if out:
                yield _result_batch(out, keep_bytes)

    def asked(batches):
        for raws, ids, marks in _byte_slices(batches, "text", "doc_id", "codes"):
            out = []
            for raw, doc, codes_of in zip(raws, ids, marks):
                anchor, place, first, count = runs_of(np.frombuffer(raw, np.uint8))
                code = np.array(codes_of)
                code = code[code >> 1 < len(anchor)]
                for k in np.unique(code[(code & 1) == SORT] >> 1).tolist():
                    out.append((int(anchor[k].view(np.int64)), doc, k, int(place[k] - first[k]), raw[first[k] : first[k] + count[k] + LENGTH - 1]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["anchor", "doc_id", "k", "anchor_at", "run"])

    has_sort = F.exists("codes", lambda c: c.bitwiseAND(F.lit(1)) == SORT)
    to_sort = joined.filter(has_sort)
    runs = to_sort.mapInArrow(asked, "anchor long, doc_id long, k long, anchor_at long, run binary")

    def sorted_runs(batches):
        held: list[tuple] = []
        size = 0

        def flush(part):
            lost = shared_windows([x[4] for x in part], np.array([x[3] for x in part]), np.array([x[1] for x in part], dtype=np.int64))
            found = [(x[1], x[2], m) for x, m in zip(part, lost) if 1 in m]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["doc_id", "k", "windows"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc_id", "k", "anchor_at", "run"))):
                if size > SORT_BYTES and row[0] != held[-1][0]:
                    yield from flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield from flush(held)

    lost = runs.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sorted_runs, "doc_id long, k long, windows binary")
    lost = lost.groupBy("doc_id").agg(F.collect_list(F.struct("k", "windows")).alias("lost"))

    def cut_sorted(batches):
        for raws, ids, marks, found in _byte_slices(batches, "text", "doc_id", "codes", "lost"):
            out = []
            for raw, doc, codes_of, own in zip(raws, ids, marks, found):
                cut, _, _, first, _ = _bulk(np.frombuffer(raw, np.uint8), codes_of)
                for x in own or []:
                    if x["k"] >= len(first):
                        continue
                    at = first[x["k"]] + np.flatnonzero(np.frombuffer(x["windows"], np.uint8))
                    cut.windows(at[at + LENGTH <= len(raw)], at[at + LENGTH <= len(raw)])
                out.append((doc, cut.result(raw)))
            if out:
                yield _result_batch(out, keep_bytes)

    rest = to_sort.join(lost, "doc_id", "left").mapInArrow(cut_sorted, RESULT)
    nameless = rows.filter("doc_id is null").select("doc_id", "text", F.array().cast("array<bigint>").alias("codes"))
    return joined.filter(~has_sort).mapInArrow(finished, RESULT).union(rest).union(nameless.mapInArrow(finished, RESULT))
