"""Merkle manifest, fingerprints and collocations against plain versions."""

import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from roadpulse.llm import fingerprint, merkle, phrases  # noqa: E402

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, node int, `at` int, grp string, key string, f int, number string"


def table(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 1, 2, "x", "y", 3, "z") for r in rows], SCHEMA)


def documents(spark, rows):
    return table(spark, [(d, "s", lang, len(t or ""), t) for d, lang, t in rows])


def third(d):
    return d is not None and zlib.crc32(str(d).encode()) % 3 == 0


def verified(df):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return merkle.verify(df, {"text": F.translate("text", upper, upper.lower())}, F.crc32(F.col("doc_id").cast("string")) % 3 == 0)


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("sizes", [[1], [1, 1], [8, 9, 1], [64, 65, 63, 513], [1200, 7], [1] * 20])
def test_manifest(spark, sizes):
    rows = []
    for g, n in enumerate(sizes):
        lang = None if g == 1 else "" if g == 2 else f"é{g}"
        rows += [(10_000 * g + i * 7 - 50, None if i % 5 == 0 else f"s:{i}", lang, None if i % 11 == 0 else i, None if i % 13 == 0 else f"Text É {i % 4} A") for i in range(n)]
    random.Random(1).shuffle(rows)
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in verified(table(spark, rows)).collect()]
    assert in_order(got) == in_order(brute.manifest(rows, third))


def test_manifest_of_repeated_rows_and_rows_without_id(spark):
    rows = [(5, "s", "en", 1, "A")] * 600 + [(None, "s", "en", 1, f"t{i % 3}") for i in range(30)] + [(7, "s", None, None, "B" * 100_000), (7, "s", None, None, "b")]
    got = verified(table(spark, rows)).collect()
    assert in_order([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got]) == in_order(brute.manifest(rows, third))
    assert all(r.verified == (r.folded_root == r.root) for r in got) and not all(r.verified for r in got if r.doc_id == 7) == third(7)


def test_manifest_finds_any_change_and_lists_groups(spark):
    rows = [(i, "s", "en" if i % 3 else None, i, f"text {i}") for i in range(100)]
    df = table(spark, rows)
    changed = merkle.verify(df, {"n_chars": F.col("n_chars") + 1}, F.col("doc_id") == 17).collect()
    assert [r.doc_id for r in changed if not r.verified] == [17]
    assert all(r.verified for r in merkle.verify(df).collect())
    whole = brute.manifest(rows)
    assert {(r.grp, r.rows, r.subroot, r.root) for r in merkle.manifest(df).collect()} == {
        (g, n, next(x[2] for x in whole if (x[0] % 3 == 0) == (g is None)), whole[0][3]) for g, n in ((None, 34), ("en", 66))}


TEXTS = [None, "", " \t\n", "one", "ONE", "one one two", "Ünï ß É", "a b c d e f g h", "word " * 5000, "x" * 2001, "tail\x0b\x0cend ", "\U0001f600 smile \U0001f600"]


def test_fingerprints(spark):
    rnd = random.Random(4)
    texts = TEXTS + [" ".join(f"w{min(rnd.randrange(40), rnd.randrange(40))}" for _ in range(rnd.randrange(1, 200))) for _ in range(20)]
    rows = [(3 * i - 9, "en", t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in fingerprint.compare_edits(documents(spark, rows)).collect()}
    for (d, _, t), (_, _, following) in zip(rows, rows[1:] + rows[:1]):
        t, following = t or "", following or ""
        q = len(t) // 4
        edited = t[: len(t) - q] + following[:q]
        marks = [brute.fingerprint(x) for x in (t, edited, following)]
        near = [sum(marks[0][i : i + 4] == m[i : i + 4] for i in range(0, 256, 4)) / 64 for m in marks[1:]]
        assert (got[d].n_chars, got[d].edited_sha256, got[d].fingerprint, got[d].edited_fingerprint, [got[d].near_edited, got[d].near_next]) == (
            len(t), brute.sha(edited.encode()), marks[0], marks[1], near)
    plain = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(documents(spark, rows)).collect()}
    assert plain == {d: r.fingerprint for d, r in got.items()}


def test_fingerprints_pass_over_most_terms_and_stay_exact(spark):
    rnd = random.Random(5)
    texts = TEXTS + [" ".join(f"w{min(rnd.randrange(500), rnd.randrange(500))}" for _ in range(rnd.randrange(100, 400))) for _ in range(20)]
    df = documents(spark, [(i, "en", t) for i, t in enumerate(texts)])
    exact = sorted(fingerprint.compare_edits(df, far=None).collect())
    assert all(sorted(fingerprint.compare_edits(df, far=far).collect()) == exact for far in (0.5, 4.0, fingerprint.FAR))  # the smaller, the more texts a second time
    terms = fingerprint.term_counts(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["doc_id"], ["text"])
    whole = [{r.whole for r in fingerprint.sampled(terms, ["doc_id"], 1, 64, far).collect()} for far in (None, 0.5, fingerprint.FAR)]
    assert whole[0] == {True} and False in whole[1] and whole[2] == {True}


def test_fingerprints_estimate_the_generalised_jaccard_similarity(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(60):
        words = [f"w{int(rnd.paretovariate(0.7)) % 300}" for _ in range(300)]
        rows += [(2 * i, "en", " ".join(words)), (2 * i + 1, "en", " ".join(words[: rnd.randrange(20, 300)] + [f"n{rnd.randrange(50)}" for _ in range(60)]))]
    marks = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(documents(spark, rows), 256).collect()}
    off = []
    for i in range(60):
        a, b = (brute.term_weights(rows[2 * i + k][2]) for k in (0, 1))
        share = np.mean([marks[2 * i][j : j + 4] == marks[2 * i + 1][j : j + 4] for j in range(0, 1024, 4)])
        off.append(share - sum((a & b).values()) / sum((a | b).values()))
    assert abs(np.mean(off)) < 0.012 and np.std(off) < 0.045  # one deviation of a mean of 60 x 256 samples is 0.004, of 256 samples 0.03


def test_fingerprints_of_repeated_rows_single_and_nameless_documents(spark):
    rows = [(4, "en", "abcd efgh"), (4, "en", "abcd efgh"), (4, "en", "other"), (None, "en", "none"), (None, "en", "none")]
    got = fingerprint.compare_edits(documents(spark, rows)).collect()
    assert len(got) == 5 and len({(r.doc_id, r.fingerprint) for r in got}) == 3
    assert all(r.edited_sha256 == brute.sha(b"nonx"[:3] + b"a") or r.edited_sha256 == brute.sha(b"nono") for r in got if r.doc_id is None)
    alone = fingerprint.compare_edits(documents(spark, [(1, "en", "abcdefgh")])).first()
    assert alone.edited_sha256 == brute.sha(b"abcdefab") and alone.near_next == 1.0


def plain_rows(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.fixture(scope="module")
def prose():
    rnd = random.Random(6)
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "; ", "\x0b", " \r\n"]
    out = []
    for i in range(120):
        words = [rnd.choice(["New", "york", "É", "the", "of", "state", "\x00", "a b", "x\x85y", "city", f"r{rnd.randrange(400)}"]) for _ in range(rnd.randrange(200))]
        out.append((rnd.choice(["en", "de", None, "und"]), "".join(w + rnd.choice(ends) for w in words)))
    return out + [("en", None), ("en", ""), (None, " . , "), ("en", "a a a a a a a a a a a a a a"), ("fr", "le " * 3000), ("es", "solo una vez")]


def test_collocations(spark, prose):
    df = documents(spark, [(i, *r) for i, r in enumerate(prose)])
    assert plain_rows(phrases.collocations(df)) == sorted(brute.collocations(prose))


@pytest.mark.parametrize("longest,least,percent,top", [(2, 10, 50, 5), (4, 3, 80, 2000), (3, 10, 50, 1)])
def test_collocations_in_shards(spark, prose, longest, least, percent, top):
    df = documents(spark, [(i, *r) for i, r in enumerate(prose + prose)])
    got = phrases.collocations(df, longest, least, percent, top, shard=25, bucket_bits=13)
    assert plain_rows(got) == sorted(brute.collocations(prose + prose, longest, least, percent, top))


def test_readings_are_stored_once_and_phrases_hashed_together(spark, prose):
    texts = documents(spark, [(i, *r) for i, r in enumerate(prose)]).selectExpr("coalesce(lang, 'und') as lang", "coalesce(text, '') as text")
    words = Counter()
    for text in phrases.readings(phrases.read_texts(texts).toArrow().to_batches()):
        at, hashes = text.runs(2)
        pairs = text.phrases(at, 2).to_pylist()
        assert len(at) == 0 or phrases.phrase_hashes([text.lang] * len(at), pairs).tolist() == hashes.tolist()
        words.update((text.lang, text.names[i].decode()) for i in text.ids[text.ids != 0].tolist())
    want = Counter((lang or "und", w) for lang, text in prose for w in re.split("[.,;:!?\x09-\x0D\x20]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w)
    assert words == want


def test_collocations_of_counts_past_64_bits(spark):
    """Counts of 10^13 are out of reach of a test; the score's arithmetic is not."""
    big = spark.range(1).selectExpr("9000000000000L as a", "9000000000000L as l", "9100000000000L as r")
    assert big.select(phrases.score()).first()[0] == 1000000 * 9 * 9 * 10**24 // (9 * 91 * 10**23)


def test_trie_of_many_words_and_languages():
    rnd = random.Random(2)
    keys = sorted({(f"l{rnd.randrange(1500)}", *(f"w{int(rnd.paretovariate(0.5)) % 5000}".encode() for _ in range(2))) for _ in range(30_000)})
    trie = phrases.Trie([k[0] for k in keys], [list(k[1:]) for k in keys])
    number = {k: i for i, k in enumerate(keys)}
    for lang in ("l3", "l700", "l1499", "none"):
        text = phrases.Reading(lang, ["\n".join(" ".join(f"w{int(rnd.paretovariate(0.5)) % 5200}" for _ in range(9)) for _ in range(300)) + " " + " ".join(f"{a.decode()} {b.decode()}." for x, a, b in keys if x == lang)])
        words = [text.names[i] for i in text.ids]
        want = [number[lang, a, b] for a, b in zip(words, words[1:]) if (lang, a, b) in number]
        assert sorted(trie.found(text).tolist()) == sorted(want)
    assert len(trie.base) < 4 * (trie.check >= 0).sum()


def test_empty_tables(spark):
    none = table(spark, [])
    assert verified(none).count() == 0 and merkle.manifest(none).count() == 0
    assert fingerprint.compare_edits(none).count() == 0 and fingerprint.fingerprints(none).count() == 0
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(documents(spark, [(1, None, None), (2, "en", "only rare words")])).count() == 0
