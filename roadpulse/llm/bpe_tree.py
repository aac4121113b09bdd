"""BPE encoding and decoding by tree concatenation.

Long text is cut in halves down to leaves, the leaves of a batch are encoded together, and neighbours are joined upward.
A join encodes a window around the seam again: it starts with one token on each side and grows on the side that disagrees
until the window's outermost tokens are those that the halves have there. The same join serves two levels. Words: cutting
a text into words reads only forward, so two scans that share a boundary agree from there on. Symbols of one long word
without any break: a sequence of BPE tokens is the encoding of its text when every neighbouring pair is, so agreement on
the outermost tokens makes the whole exact.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from .common import Words, id_and_text, map_texts
from .cutting import Cutter

#: Characters of a leaf of text, symbols of a leaf of one word.
LEAF_CHARS, LEAF_SYMBOLS = 4096, 256
CACHED_CHARS = 64
#: Encoding a word is dear, so its results may take more room than those of others.
CACHE_SHARE = 3
#: Words that the library encodes in one call.
ENCODED_AT_ONCE = 10_000

#: Fixed by the vocabulary: its words; the blanks after a word, or at the start of a text, go with them here.
WORD = r"(?:\p{L}+|'(?:[stmd]|re|ve|ll)|\p{N}|[^\s\p{L}\p{N}]+)\s*|\s+"

Encode = Callable[[str, bool], list]


def halves(text: str, leaf: int) -> list[str]:
    """The leaves of a text: halved until none is longer than ``leaf``; left to right."""
    if len(text) <= leaf:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], leaf) + halves(text[middle:], leaf)


def join(left: list, right: list, ends: bool, encode: Encode, text_of: Callable[[Iterable], str]) -> list:
    """The encoding of two neighbours' text from theirs. ``ends``: the right one ends the whole text."""
    if not left or not right:
        return left or right
    a = b = 1
    while True:
        a, b = min(a, len(left)), min(b, len(right))
        window = encode(text_of(left[-a:] + right[:b]), ends and b == len(right))
        left_agrees = a == len(left) or window[0] == left[-a]
        right_agrees = b == len(right) or window[-1] == right[b - 1]
        if left_agrees and right_agrees:
            return left[: len(left) - a] + window + right[b:]
        a, b = a if left_agrees else 2 * a, b if right_agrees else 2 * b


def tree(nodes: list[list], encode: Encode, text_of: Callable[[Iterable], str]) -> list:
    """Joins the encoded leaves of one text pairwise, level by level."""
    while len(nodes) > 1:
        pairs = range(0, len(nodes) - 1, 2)
        joined = [join(nodes[i], nodes[i + 1], i + 2 == len(nodes), encode, text_of) for i in pairs]
        nodes = joined + nodes[len(nodes) - len(nodes) % 2 :]
    return nodes[0]


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class WordCodec:
    """Encodes and decodes with a vocabulary of word-end BPE, as its library does for whole texts."""

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        # Every core has a worker of its own already; threads of the library would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.normalizer = Tokenizer.from_file(path).normalizer
        # Words come normalised, so the library encodes them without its normalizer, truncation and padding.
        self.library = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "truncation": None, "padding": None}))
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.whole, self.inner = self.library.model, BPE(vocab=model["vocab"], merges=merges)
        self.cut = Cutter(WORD)
        self.blank = regex.compile(r"\s+")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.names = {i: t for t, i in self.library.get_vocab(with_added_tokens=True).items()}
        self.known = Words(CACHE_SHARE)

    def words(self, text: str) -> list[str]:
        """Words with the blanks after them; together they are the text."""
        leaves = halves(text, LEAF_CHARS)
        if len(leaves) == 1:
            return self.cut(text)
        return tree([self.cut(x) for x in leaves], lambda x, _: self.cut(x), "".join)

    def normal(self, text: str) -> str:
        return text.lower() if text.isascii() else self.normalizer.normalize_str(text)

    def symbols(self, word: str) -> list[tuple[str, int]]:
        """(characters, id) of the tokens of a word; in byte-level characters, the word end not among them."""
        def encode(part: str, ends: bool) -> list[tuple[str, int]]:
            if not ends:
                return [(t.value, t.id) for t in self.inner.tokenize(part)]
            found = [(t.value, t.id) for t in self.whole.tokenize(part)]
            return [*found[:-1], (found[-1][0].removesuffix(self.end), found[-1][1])]

        mapped = "".join(part for part, _ in self.library.pre_tokenizer.pre_tokenize_str(word))
        leaves = halves(mapped, LEAF_SYMBOLS)
        nodes = [encode(x, i + 1 == len(leaves)) for i, x in enumerate(leaves)]
        return tree(nodes, encode, lambda tokens: "".join(t for t, _ in tokens))

    def learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """Packed ids of words not met before."""
        bare = {w: w if w.isalnum() else self.blank.sub("", w) for w in words}
        fresh = set(bare.values())
        short = [w for w in fresh if len(w) <= LEAF_SYMBOLS // 4]
        made = {}
        for lo in range(0, len(short), ENCODED_AT_ONCE):
            part = short[lo : lo + ENCODED_AT_ONCE]
            made.update((w, packed(e.ids)) for w, e in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False)))
        for w in fresh.difference(made):
            made[w] = packed([i for _, i in self.symbols(w)])
        return {w: made[b] for w, b in bare.items()}

    def decode(self, ids: bytes) -> str:
        """The text of packed ids."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def __call__(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit numbers, decoded text) of each text."""
        cut: list[list[str]] = []
        for text in texts:
            parts = self.specials.split(text) if "<|" in text else [text]
            cut.append([w for p in parts for w in ([p] if p in self.special else self.words(self.normal(p)))] if len(parts) > 1
                       else self.words(self.normal(text)))
        self.known.make_room()
        if not self.known:
            self.known.update((s, packed([i])) for s, i in self.special.items())
        fresh = self.learn(self.known.unmet(chain.from_iterable(cut)))
        self.known.add({w: v for w, v in fresh.items() if len(w) <= CACHED_CHARS}, 165)
        out = []
        for words in cut:
            try:
                ids = b"".join(map(self.known.__getitem__, words))
            except KeyError:
                ids = b"".join([self.known[w] if w in self.known else fresh[w] for w in words])
            out.append((ids, self.decode(ids)))
        return out


@lru_cache(maxsize=2)
def codec(path: str | None) -> WordCodec:
    """One per Python worker; without a path, the word-end vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return WordCodec(path or public_tokenizers.path("word_bpe_49k.json"))


def encode_decode(docs: DataFrame, vocab_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (binary, little-endian unsigned 32-bit), decoded (string).

    Null text counts as empty: no ids, empty decoded text. A very long text is cut in halves and joined again. Repeated rows give repeated results.
    """
    def work(texts: list[str]) -> dict:
        found = codec(vocab_path)(texts)
        return {"ids": [a for a, _ in found], "decoded": [b for _, b in found]}

    return map_texts(id_and_text(docs, id_col, text_col), work, "doc_id long, ids binary, decoded string", ["doc_id"])


def encode_digests(docs: DataFrame, vocab_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256; made where the ids are, so they do not travel."""
    def work(texts: list[str]) -> dict:
        found = codec(vocab_path)(texts)
        return {
            "n_tokens": np.array([len(a) // 4 for a, _ in found], dtype=np.int64).tolist(),
            "ids_sha256": [hashlib.sha256(a).hexdigest() for a, _ in found],
            "decoded_sha256": [hashlib.sha256(b.encode()).hexdigest() for _, b in found],
        }

    return map_texts(id_and_text(docs, id_col, text_col), work,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", ["doc_id"])
