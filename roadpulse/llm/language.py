"""Language ID: scripts narrow the candidates, Viterbi over per-word scores labels spans.

The model is counts of letter n-grams per language, learned from a bounded number of labelled documents. A word's score for
a language is the log-likelihood of its n-grams; languages whose texts do not use the word's script are no candidates for
it. Along a document the best path pays a penalty for every change of language, which yields spans of mixed-language text.
The search runs over all texts of a slice side by side, and over the blocks of a long text side by side.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, id_and_text, map_texts, release, slices

#: Labelled documents per language that the model is fitted on, about; those whose ids hash to the lowest numbers.
FIT_DOCS_PER_LANG = 3000
#: n-grams are hashed to this many buckets; languages beyond so many (by number of documents) would not fit the driver.
BUCKETS, ORDERS = 1 << 15, (1, 2, 3)
SWITCH_PENALTY = 12.0
#: A word can speak for a language against another by so much at most, so one odd word does not make a span.
MOST_PER_WORD = 8.0
LEAST_SCRIPT_SHARE = 0.01
#: Steps of a score's unit, and words of a block of a long text.
SCALE, BLOCK = 1024, 512
UNKNOWN = "und"
#: First letters of script ranges (fixed values of the Unicode blocks); a letter belongs to the last range that starts at or before it.
SCRIPT_STARTS = [0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x900, 0xE00, 0x10A0, 0x1100, 0x1E00, 0x1F00, 0x2C60, 0x3040,
                          0x30A0, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0xF900, 0x20000]
SCRIPTS = ["latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "georgian", "hangul", "latin", "greek",
           "latin", "kana", "kana", "other", "han", "other", "hangul", "other", "han", "han"]
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
ASCII_WORDS = re.compile(r"[a-z]+")


def script_of(word: str) -> str:
    """The script of a word's first letter."""
    return SCRIPTS[bisect_right(SCRIPT_STARTS, ord(word[0])) - 1]


def ngram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of all n-grams of the words, each with a blank before and after."""
    letters = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    owners, buckets = [], []
    for n in ORDERS:
        if len(letters) < n:
            continue
        code = np.full(len(letters) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            code = (code * np.uint64(0x9E3779B97F4A7C15)) ^ (letters[i : len(letters) - n + 1 + i] + np.uint64(0x7F4A7C15))
        code = (code * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - 15)
        same = owner[: len(code)] == owner[n - 1 :]
        owners.append(owner[: len(code)][same])
        buckets.append(code[same].astype(np.int64))
    return np.concatenate(owners), np.concatenate(buckets)


@dataclass
class Model:
    """Languages, log-likelihoods (bucket x language), and which languages use which script."""

    langs: list[str]
    scores: np.ndarray
    scripts: dict[str, np.ndarray]


def fit(labelled: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
        docs_per_lang: int = FIT_DOCS_PER_LANG) -> Model:
    """The model of the labelled rows; rows with a null language or text are not used.

    About ``docs_per_lang`` documents per language are read, chosen by a hash of the id, whatever the size of the input: a
    count of the documents gives the share of the hash range that holds so many. Languages are those of the column, so
    their number is bounded by the label set.
    """
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), (F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 32)) / (1 << 32)).alias("at"), F.col(text_col).alias("text"))
    shares = {r["lang"]: docs_per_lang / r["count"] for r in rows.groupBy("lang").count().collect()}
    chosen = reduce(lambda a, b: a | b, [(F.col("lang") == k) & (F.col("at") < v) for k, v in shares.items()], F.lit(False))
    picked = rows.filter(chosen)

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        scripts: dict[tuple[str, str], int] = {}
        for part, texts in slices(batches, "text"):
            for lang, text in zip(part.column("lang").to_pylist(), texts):
                words = Counter(WORDS.findall(text.lower()))
                if words:
                    owner, buckets = ngram_buckets(list(words))
                    times = np.fromiter(words.values(), dtype=float, count=len(words))
                    totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    totals[lang] += np.bincount(buckets, weights=times[owner], minlength=BUCKETS).astype(np.int64)
                    for w, n in words.items():
                        s = script_of(w)
                        scripts[lang, s] = scripts.get((lang, s), 0) + n
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(used), "bucket": used, "script": [None] * len(used), "n": total[used]}, schema=schema)
        for (lang, s), n in scripts.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang], "bucket": [-1], "script": [s], "n": [n]}, schema=schema)
        release()

    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("script", pa.string()), ("n", pa.int64())])
    counted = picked.select("lang", "text").repartition(12, F.xxhash64("text")).mapInArrow(count, "lang string, bucket long, script string, n long")
    # At most buckets x languages rows: a bound that does not grow with the documents.
    found = counted.groupBy("lang", "bucket", "script").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique())
    counts = np.full((BUCKETS, max(len(langs), 1)), 0.5)
    grams = found[found["bucket"] >= 0]
    np.add.at(counts, (grams["bucket"].to_numpy(dtype=np.int64), grams["lang"].map(langs.index).to_numpy(dtype=np.int64)), grams["n"].to_numpy(dtype=float))
    used = found[found["bucket"] < 0]
    scripts: dict[str, np.ndarray] = {}
    for k, lang in enumerate(langs):
        own = used[used["lang"] == lang]
        for s, n in zip(own["script"], own["n"]):
            if n >= LEAST_SCRIPT_SHARE * own["n"].sum():
                scripts.setdefault(s, np.zeros(len(langs), dtype=bool))[k] = True
    return Model(langs, np.log(counts / counts.sum(axis=0)).astype(np.float32), scripts)


def sweep(scores: np.ndarray, start: np.ndarray, size: np.ndarray, total: np.ndarray, penalty, back: np.ndarray | None = None) -> np.ndarray:
    """Viterbi over many rows side by side, a word of each at a step; returns ``total`` (row x language) after their last words.

    Row r reads the scores of the words from ``start[r]`` on; ``size`` falls from row to row. ``back`` takes the language
    of the word before, for every word and language; staying wins over changing.
    """
    own = np.arange(scores.shape[1])
    live = len(size) - np.searchsorted(size[::-1], np.arange(size[0] if len(size) else 0), side="right")
    for i, m in enumerate(live.tolist()):
        now, at = total[:m], start[:m] + i
        top = now.argmax(axis=1)
        changed = now[np.arange(m), top][:, None] - penalty
        if back is not None:
            back[at] = np.where(now >= changed, own, top[:, None])
        np.maximum(now, changed, out=now)
        now += scores[at]
    return total


def trace(back: np.ndarray, start: np.ndarray, size: np.ndarray, last: np.ndarray, path: np.ndarray) -> None:
    """Follows ``back`` from the languages of the last words and writes the languages of all words to ``path``."""
    state = last.copy()
    live = len(size) - np.searchsorted(size[::-1], np.arange(size[0] if len(size) else 0), side="right")
    for i in range(len(live) - 1, -1, -1):
        m = live[i]
        at = start[:m] + i
        path[at] = state[:m]
        state[:m] = back[at, state[:m]]


def best_paths(scores: np.ndarray, sizes: np.ndarray, penalty) -> np.ndarray:
    """Viterbi: the language of every word on its text's path with the largest sum of scores less ``penalty`` per change.

    ``scores`` (word x language) holds the texts one behind the other, ``sizes`` their numbers of words. Texts go side by
    side; one of more than ``BLOCK`` words is cut into blocks that go side by side as well, each once for every language
    before it, and the blocks' (max, +) matrices are chained. Of equal paths, one of a single language wins.
    """
    k = scores.shape[1]
    kind, never = (np.int64, -(1 << 50)) if scores.dtype.kind == "i" else (np.float64, -1e18)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    path, back = np.zeros(len(scores), dtype=np.int64), np.zeros(scores.shape, dtype=np.int16)
    before = np.where(np.eye(k, dtype=bool), kind(0), kind(never))

    rows = np.flatnonzero((sizes > 0) & (sizes <= BLOCK))
    rows = rows[np.argsort(-sizes[rows], kind="stable")]
    total = sweep(scores, starts[rows], sizes[rows], np.zeros((len(rows), k), dtype=kind), penalty, back)
    trace(back, starts[rows], sizes[rows], total.argmax(axis=1), path)

    long = np.flatnonzero(sizes > BLOCK)
    if len(long):
        first = np.concatenate([np.arange(starts[t], ends[t], BLOCK) for t in long])
        size = np.concatenate([np.minimum(BLOCK, ends[t] - np.arange(starts[t], ends[t], BLOCK)) for t in long])
        order = np.argsort(-size, kind="stable")
        made = sweep(scores, np.repeat(first[order], k), np.repeat(size[order], k), np.tile(before, (len(order), 1)), penalty).reshape(-1, k, k)
        gain = np.empty_like(made)
        gain[order] = made
        enter, leave, b = np.empty(len(first), dtype=np.int64), np.empty(len(first), dtype=np.int64), 0
        for t in long:
            blocks = range(b, b + -(-int(sizes[t]) // BLOCK))
            total, came = np.zeros(k, dtype=kind), []
            for b in blocks:
                ways = total[:, None] + gain[b]
                came.append(ways.argmax(axis=0))
                total = ways.max(axis=0)
            state = int(total.argmax())
            for b, by in zip(reversed(blocks), reversed(came)):
                leave[b] = state
                enter[b] = state = by[state]
            b = blocks.stop
        sweep(scores, first[order], size[order], before[enter[order]], penalty, back)
        trace(back, first[order], size[order], leave[order], path)

    # Of equal paths the one of a single language wins.
    some = np.flatnonzero(sizes > 0)
    if len(some):
        whole = np.add.reduceat(scores, starts[some], axis=0, dtype=kind)
        of = np.repeat(np.arange(len(some)), sizes[some])
        changes = np.bincount(of[1:], weights=(path[1:] != path[:-1]) & (of[1:] == of[:-1]), minlength=len(some)).astype(np.int64)
        gained = np.add.reduceat(scores[np.arange(len(path)), path], starts[some], dtype=kind) - penalty * changes
        single = (changes > 0) & (whole.max(axis=1) >= gained)
        path = np.where(single[of], whole.argmax(axis=1)[of], path)
    return path


def best_path(scores: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best path of one text."""
    return best_paths(scores, np.array([len(scores)]), penalty)


class Labeller:
    """Labels texts with a model; remembers the scores of words, as many as ``CACHE_BYTES`` hold. Scores are whole numbers,
    so sums and ties do not depend on the order of additions."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, Words()
        self.table, self.lengths = np.empty((0, len(model.langs)), dtype=np.int32), np.empty(0, dtype=np.int64)

    def learn(self, words: list[str]) -> None:
        made = np.zeros((len(words), len(self.model.langs)), dtype=np.float32)
        for lo in range(0, len(words), 20_000):
            owner, bucket = ngram_buckets(words[lo : lo + 20_000])
            for k in range(made.shape[1]):
                made[lo : lo + 20_000, k] = np.bincount(owner, weights=self.model.scores[bucket, k], minlength=len(words[lo : lo + 20_000]))
        made -= made.max(axis=1, keepdims=True)
        np.maximum(made, -MOST_PER_WORD, out=made)
        scripts = np.array([script_of(w) for w in words])
        for s, users in self.model.scripts.items():
            if not users.all():
                made[np.ix_(scripts == s, ~users)] = -MOST_PER_WORD
        self.known.add(dict(zip(words, range(len(self.table), len(self.table) + len(words)))), 200 + 4 * made.shape[1])
        self.table = np.concatenate([self.table, np.rint(made * SCALE).astype(np.int32)])
        self.lengths = np.concatenate([self.lengths, np.fromiter(map(len, words), dtype=np.int64, count=len(words))])

    def __call__(self, texts: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """(language, score, spans as (start word, end word, language)) of each text."""
        langs = self.model.langs
        if not langs:
            return [(UNKNOWN, 0.0, [])] * len(texts)
        cut = [(ASCII_WORDS if t.isascii() else WORDS).findall(t.lower()) for t in texts]
        if self.known.make_room():
            self.table, self.lengths = self.table[:0].copy(), self.lengths[:0].copy()
        fresh = self.known.unmet(chain.from_iterable(cut))
        if fresh:
            self.learn(sorted(fresh))
        sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=int(sizes.sum()))
        return self.label(at, sizes)

    def label(self, at: np.ndarray, sizes: np.ndarray) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """The results of texts given as places of their words in the table, one text behind the other."""
        langs, some = self.model.langs, np.flatnonzero(sizes > 0)
        found = [(UNKNOWN, 0.0, [])] * len(sizes)
        if not len(some):
            return found
        k, scores, letters, n = len(langs), self.table[at], self.lengths[at], sizes[some]
        path = best_paths(scores, n, int(SWITCH_PENALTY * SCALE))
        starts, of = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
        share = np.bincount(of * k + path, weights=letters, minlength=len(n) * k).reshape(-1, k)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        # How sure the words of the winning spans are of it, against the next language.
        own = np.add.reduceat(np.where((path == best[of])[:, None], scores, 0), starts, axis=0, dtype=np.int64)
        above = np.minimum(own - own[np.arange(len(n)), best][:, None], 0) / SCALE
        score = share[np.arange(len(n)), best] / np.exp(above).sum(axis=1)
        opens = np.ones(len(path), dtype=bool)
        opens[1:] = (path[1:] != path[:-1]) | (of[1:] != of[:-1])
        cuts = np.flatnonzero(opens)
        stops = np.append(cuts[1:], len(path)) - starts[of[cuts]]
        spans: list[list[tuple[int, int, str]]] = [[] for _ in n]
        for t, a, b, x in zip(of[cuts].tolist(), (cuts - starts[of[cuts]]).tolist(), stops.tolist(), path[cuts].tolist()):
            spans[t].append((a, b, langs[x]))
        for i, x, s, own_spans in zip(some.tolist(), best.tolist(), score.tolist(), spans):
            found[i] = langs[x], s, own_spans
        return found


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (0 to 1), spans (of words: start, end, language).

    ``und`` with score 0 and no spans when the text is null or has no letter. A very long text is a slice of its own, read
    as a whole. Repeated rows give repeated results.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers
    held: list[Labeller] = []

    def work(texts: list[str]) -> dict:
        if not held:
            held.append(Labeller(sent.value))
        found = held[0](texts)
        return {
            "lang_pred": pa.array([f[0] for f in found], pa.string()), "score": pa.array([f[1] for f in found], pa.float64()),
            "spans": pa.array([",".join(f"{a}:{b}:{x}" for a, b, x in f[2]) for f in found], pa.string()),
        }

    return map_texts(id_and_text(docs, id_col, text_col), work, "doc_id long, lang_pred string, score double, spans string", ["doc_id"])


def held_out(id_col: str = "doc_id"):
    """Documents the model never learns from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def keep_identified(docs: DataFrame, least: float, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents whose language is known with a score of ``least`` or more, with all their columns; no shuffle.

    The model learns from those of them that are labelled and not held out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs.filter(~held_out(id_col)), lang_col, id_col, text_col))
    held: list[Labeller] = []
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            named = pa.RecordBatch.from_arrays([pc.fill_null(batch.column(place).cast(pa.string()), "")], names=["text"])
            keep = []
            for _, texts in slices([named], "text"):
                if not held:
                    held.append(Labeller(sent.value))
                keep += [lang != UNKNOWN and score >= least for lang, score, _ in held[0](texts)]
            yield batch.filter(pa.array(keep, pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)
