"""Secret scans: spans by pattern, and random strings that a token vocabulary cannot compress.

Written words cost few tokens for their length; random strings cost many. A run of key-like characters whose characters
per token stay low under the vocabulary is reported, unless its form is that of a digest or an identifier. Where a run as a
whole reads well, the stretches of it that do not are reported: a key behind a path of words is found.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import accumulate, takewhile

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, map_texts

#: Fixed by the contract.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_HEX = re.compile(r"[0-9a-f]{24}")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "random"]
#: Random strings: least length, and characters per token below which a run counts as random.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MOST_CHARS_PER_TOKEN = 2.0
#: Lengths of hexadecimal digests in use.
DIGESTS = {32, 40, 48, 56, 64, 96, 128}
UUID = r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
#: Numbers and dates, dashed names and paths made of short words. A part of 20 letters or more is no word: its tokens tell.
IDENTIFIER = re.compile(
    r"[0-9_/=+-]+|[-_/]*(?:[A-Za-z]{1,19}[0-9]{0,4}|[0-9]{1,4})(?:[-_/]+(?:[A-Za-z]{1,19}[0-9]{0,4}|[0-9]{1,4}))+[-_/]*")
#: UUIDs and digests inside a run.
KNOWN = re.compile(rf"(?<![0-9A-Za-z])(?:{UUID}|{'|'.join(f'[0-9A-Fa-f]{{{n}}}' for n in sorted(DIGESTS))})(?![0-9A-Za-z])")
LEAST_RUN = 20
PART = re.compile(r"[A-Za-z0-9]{20,}")
MARKS = "+/_=-"


@lru_cache(maxsize=2)
def encoding(path: str | None):
    """One per Python worker; without a path, the byte-level ranks of the installed public tokenizers."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def known_form(run: str) -> bool:
    """Digests and identifiers, which are not secrets."""
    return KNOWN.fullmatch(run) is not None or IDENTIFIER.fullmatch(run) is not None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern kinds, leftmost and non-overlapping per kind, those of full length."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if LEAST_HEX.search(text):
        spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def stretches(sizes: list[int], most: float) -> list[tuple[int, int]]:
    """The stretches of tokens (first, end) that cost most for their length: all maximal ones, each token counting ``most`` less
    its characters. Every token enters and leaves the list of candidates once, so time grows with the run.
    """
    found: list[tuple[int, int, float, float]] = []  # first, end, total before the first, total at the end
    total = 0.0
    links: list[int] = []  # of each candidate: the nearest one before it that begins lower, or -1
    for i, size in enumerate(sizes):
        before, total = total, total + most - size
        if size >= most:
            continue
        first, low = i, before
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = links[j]
            if j < 0 or found[j][3] >= total:
                break
            first, low = found[j][0], found[j][2]  # what lies between is gained back: both are one stretch
            del found[j:], links[j:]
        found.append((first, i + 1, low, total))
        links.append(j)
    return [(a, b) for a, b, _, _ in found]


def random_parts(run: str, most: float, vocab_path: str | None) -> list[tuple[int, int]]:
    """(start, end) of what is random in a run: the run, if its ratio is low as a whole; or else the parts between marks whose
    ratio is low, and the stretches of low ratio, joined where they overlap."""
    code = encoding(vocab_path)
    tokens = code.decode_tokens_bytes(code.encode_ordinary(run))
    if len(run) < most * len(tokens) and not known_form(run):
        return [(0, len(run))]
    found, ends = [], [0, *accumulate(map(len, tokens))]
    for m in PART.finditer(run):
        if len(m[0]) < most * len(code.encode_ordinary(m[0])) and not known_form(m[0]):
            found.append(m.span())
    for a, b in stretches(list(map(len, tokens)), most):
        piece = run[ends[a] : ends[b]]
        start = ends[a] + len(piece) - len(piece.lstrip(MARKS))
        piece = piece.strip(MARKS)
        if len(piece) >= LEAST_RUN and not known_form(piece):
            found.append((start, start + len(piece)))
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def random_spans(text: str, base: list[tuple[int, int, str]], most: float, vocab_path: str | None) -> list[tuple[int, int, str]]:
    """What costs many tokens for its length in the runs between base spans, UUIDs and digests, and is no identifier."""
    out, at = [], 0
    for m in RUN.finditer(text):
        while at < len(base) and base[at][1] <= m.start():
            at += 1
        taken = [(a, b) for a, b, _ in takewhile(lambda s: s[0] < m.end(), base[at:])]
        taken += [(m.start() + k.start(), m.start() + k.end()) for k in KNOWN.finditer(m[0])]
        start = m.start()
        for a, b in [*sorted(taken), (m.end(), m.end())]:
            if a - start >= LEAST_RUN:
                out += [(start + x, start + y, "random") for x, y in random_parts(text[start:a], most, vocab_path)]
            start = max(start, b)
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan_secrets(docs: DataFrame, most_chars_per_token: float = MOST_CHARS_PER_TOKEN, vocab_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_random, base_spans, spans.

    Spans are written kind:start:end in code points with the end exclusive, ordered by start and kind. Null text counts as
    empty and has none. Repeated rows give repeated results. Very long texts are read as a whole; time grows with their length.
    """
    def work(texts: list[str]) -> dict:
        base = [base_spans(t) for t in texts]
        extra = [random_spans(t, b, most_chars_per_token, vocab_path) for t, b in zip(texts, base)]
        counts = {f"n_{k}": pa.array([sum(s[2] == k for s in b) for b in base], pa.int64()) for k in ("assign", "access", "hex")}
        return counts | {
            "n_random": pa.array(list(map(len, extra)), pa.int64()),
            "base_spans": pa.array(map(joined, base), pa.string()),
            "base_sha256": pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
            "spans": pa.array([joined(sorted(b + e, key=lambda s: (s[0], KINDS.index(s[2])))) for b, e in zip(base, extra)], pa.string()),
        }

    schema = ("doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_spans string, base_sha256 string, "
              "spans string")
    return map_texts(id_and_text(docs, id_col, text_col), work, schema, ["doc_id"])
