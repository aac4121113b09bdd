"""Token counts by rank-synchronous merging of ragged numpy arrays.

Each map task cuts texts into pre-tokens and looks them up in a bounded cache. The pre-tokens it has not met lie one after
the other in flat arrays; in every round each sequence applies its own lowest-rank pair, at all its places at once, so the
number of rounds is that of the longest merge chain and not of the symbols. Sequences longer than ``LONG`` symbols (text
without any break) are merged alone, by buckets of places per rank, where a round touches only the places of its pair.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, id_and_text, map_texts
from .cutting import Cutter

LONG = 512
CACHED_BYTES = 64
NEVER = np.int64(2**31)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where printable, else from 256 upward."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(extra)) for b in range(256)]


class MergeTable:
    """Vocabulary and merges of a byte-level BPE file, as sorted arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.first = np.array([vocab[c] for c in byte_symbols()], dtype=np.int64)
        self.width = np.int64(max(vocab.values()) + 1)
        keys = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or NEVER."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NEVER)

    def count(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token when no pair can merge."""
        counts = np.zeros(len(words), dtype=np.int64)
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        for i, w in enumerate(words):
            if len(w) > LONG:
                counts[i] = self.merge_long(self.first[np.frombuffer(w, np.uint8)])
        if short:
            counts[short] = self._rounds([words[i] for i in short])
        return counts

    def _rounds(self, words: list[bytes]) -> np.ndarray:
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        counts = sizes.copy()
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        while len(symbols) > 1:
            rank = self.ranks(symbols[:-1], symbols[1:])
            rank[owner[:-1] != owner[1:]] = NEVER
            lowest = np.full(len(words), NEVER)
            np.minimum.at(lowest, owner[:-1], rank)
            live = lowest < NEVER
            if not live.any():
                break
            hit = np.flatnonzero((rank == lowest[owner[:-1]]) & (rank < NEVER))
            # A run of touching hits (a pair of equal symbols) merges at every second place from its left end.
            opens = np.ones(len(hit), dtype=bool)
            opens[1:] = (hit[1:] - hit[:-1] > 1) | (owner[hit[1:]] != owner[hit[:-1]])
            start = hit[np.maximum.accumulate(np.where(opens, np.arange(len(hit)), 0))]
            hit = hit[(hit - start) % 2 == 0]
            symbols[hit] = self.made[rank[hit]]
            np.subtract.at(counts, owner[hit], 1)
            stay = np.ones(len(symbols), dtype=bool)
            stay[hit + 1] = False
            stay &= live[owner]  # sequences that are done leave the arrays
            symbols, owner = symbols[stay], owner[stay]
        return counts

    def merge_long(self, symbols: np.ndarray) -> int:
        """Symbols left of one long sequence."""
        symbols = symbols.copy()
        n = left = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        alive = np.ones(n, dtype=bool)
        places: dict[int, list[np.ndarray]] = {}
        ready: list[int] = []

        def add(at: np.ndarray) -> None:
            rank = self.ranks(symbols[at], symbols[after[at]])
            keep = rank < NEVER
            at, rank = at[keep], rank[keep]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for part, r in zip(np.split(at, cuts), rank[np.concatenate(([0], cuts))].tolist() if len(rank) else []):
                if r not in places:
                    places[r] = []
                    heapq.heappush(ready, r)
                places[r].append(part)

        add(np.arange(n - 1))
        while ready:
            r = heapq.heappop(ready)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[alive[at]]
            at = at[after[at] < n]
            at = at[self.ranks(symbols[at], symbols[after[at]]) == r]
            if not len(at):
                continue
            opens = np.ones(len(at), dtype=bool)
            opens[1:] = after[at[:-1]] != at[1:]
            index = np.arange(len(at))
            at = at[(index - np.maximum.accumulate(np.where(opens, index, 0))) % 2 == 0]
            gone = after[at]
            symbols[at] = self.made[r]
            alive[gone] = False
            left -= len(at)
            after[at] = after[gone]
            inner = after[at] < n
            before[after[at][inner]] = at[inner]
            firsts = before[at]
            changed = np.unique(np.concatenate((at[inner], firsts[firsts >= 0])))
            add(changed)
        return left


class TokenCounter:
    """Counts tokens of texts; remembers the counts of short pre-tokens, a bounded number of them."""

    def __init__(self, path: str) -> None:
        import public_tokenizers

        self.table = MergeTable(path)
        self.words = Cutter(public_tokenizers.PATTERN)
        self.special = re.compile("(?:" + "|".join(map(re.escape, self.table.special)) + ")") if self.table.special else None
        self.known = Words()

    def __call__(self, texts: list[str]) -> list[int]:
        totals = [0] * len(texts)
        cut: list[list[str]] = []
        for i, text in enumerate(texts):
            parts = [text]
            if self.special is not None and "<" in text:
                parts = self.special.split(text)
                totals[i] += len(parts) - 1
            cut.append([w for p in parts for w in self.words(p)] if len(parts) > 1 else self.words(text))
        self.known.make_room()
        fresh = list(self.known.unmet(chain.from_iterable(cut)))
        counts = dict(zip(fresh, self.table.count([w.encode("utf-8", "replace") for w in fresh]).tolist()))
        self.known.add({w: n for w, n in counts.items() if len(w) <= CACHED_BYTES}, 170)
        for i, words in enumerate(cut):
            try:
                totals[i] += sum(map(self.known.__getitem__, words))
            except KeyError:
                totals[i] += sum(self.known[w] if w in self.known else counts[w] for w in words)
        return totals


@lru_cache(maxsize=2)
def counter(path: str | None) -> TokenCounter:
    """One per Python worker; without a path, the byte-level vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return TokenCounter(path or public_tokenizers.path("byte_bpe_50k.json"))


def token_counts(docs: DataFrame, limit: int = 512, vocab_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    Null text counts as empty: no bytes, no tokens. A very long text is a slice of its own and is counted as a whole. A special string inside a text is one token, as in the library.
    Repeated rows give repeated results.
    """
    def work(texts: list[str]) -> dict:
        return {"n_tokens": pa.array(counter(vocab_path)(texts), pa.int64())}

    rows = id_and_text(docs, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return map_texts(rows, work, "doc_id long, n_bytes long, n_tokens long", ["doc_id", "n_bytes"]).withColumn(
        "over_limit", F.col("n_tokens") > limit)
