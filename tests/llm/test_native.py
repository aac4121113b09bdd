"""Exact dedup, decontamination, near-dedup, suffix dedup and components against plain versions."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from roadpulse.llm import components, decontaminate, exact_dedup, near_dedup, suffix_dedup  # noqa: E402

SCHEMA = "doc_id long, text string, kept string, component_id string, hash int"


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows], SCHEMA)


def prose(rnd, n, words=400):
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    base, passage = prose(rnd, 300), prose(rnd, 60)
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "a b c"), (7, "A  b\tC"), (8, base), (9, base + " "), (10, base.upper())]
    for i in range(30):
        words = base.split()
        for _ in range(i % 7):
            words[rnd.randrange(len(words))] = "changed"
        out.append((100 + i, " ".join(words)))
    out += [(200 + i, prose(rnd, 40) + " " + passage + " " + prose(rnd, 40)) for i in range(20)]
    out += [(300, "ab" * 400), (301, "x" + "ab" * 300), (302, "z" * 500), (303, "é" * 200), (304, "é" * 150 + "q" * 60), (305, prose(rnd, 40_000))]
    return out


def test_exact(spark, rows):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_groups(frame(spark, rows)).collect()}
    assert got == brute.exact(rows)


def test_exact_separates_colliding_hashes(spark, rows):
    weak = exact_dedup.exact_groups(frame(spark, rows), hash_of=lambda c: F.unhex(F.lit("00")))
    assert {r.doc_id: r.keep_id for r in weak.collect()} == {d: x[0] for d, x in brute.exact(rows).items()}


def test_exact_without_ids(spark):
    got = exact_dedup.exact_groups(frame(spark, [(None, "a"), (None, "a"), (5, "a b"), (5, "a b"), (-3, "ab"), (None, "z")])).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in got) == [
        (-3, 5, 3, False), (0, 0, 1, False), (0, 0, 2, False), (0, 0, 2, False), (5, 5, 3, True), (5, 5, 3, True)]


def test_exact_extreme_ids(spark):
    ids = [-(2**63), 2**63 - 1, 0, -1]
    got = exact_dedup.exact_groups(frame(spark, [(i, "same") for i in ids])).collect()
    assert {r.keep_id for r in got} == {-(2**63)} and sum(r.kept for r in got) == 1


def test_keep_first_keeps_columns(spark, rows):
    kept = exact_dedup.keep_first(frame(spark, [*rows, (None, "nameless")]))
    assert kept.columns == ["doc_id", "text", "kept", "component_id", "hash"]
    want = {d for d, x in brute.exact(rows).items() if x[2]}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == want | {None}


ONE_ID = [(5, "a b"), (5, "ab"), (6, "some other words"), (None, "ab")]


def test_filters_judge_unlike_texts_of_one_id_one_by_one(spark):
    def left(kept):
        return [(str(r.doc_id), r.text) for r in kept.orderBy("doc_id", F.length("text").desc()).select("doc_id", "text").collect()]

    assert left(exact_dedup.keep_first(frame(spark, ONE_ID))) == [("None", "ab"), ("5", "a b"), ("6", "some other words")]
    words = [f"w{i}" for i in range(40)]
    near, apart = " ".join(words), " ".join(w.upper() + "x" for w in words)
    rows = [(3, near), (5, apart), (5, near), (5, near + " "), (7, "short"), (7, "other"), (8, None)]
    # The copies of 3 go, the unlike text under the same id stays, as do both unlike texts of 7.
    assert set(left(near_dedup.keep_one(frame(spark, rows)))) == {("3", near), ("5", apart), ("7", "short"), ("7", "other"), ("8", None)}
    items = spark.createDataFrame([(1, near)], "item_id long, text string")
    rows = [(3, near), (5, apart), (5, "before " + near + " after"), (6, None)]
    assert set(left(decontaminate.drop_leaks(frame(spark, rows), items))) == {("5", apart), ("6", None)}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near(spark, rows, size, percent):
    got = near_dedup.near_groups(frame(spark, [*rows, (None, "nameless")]), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute.near(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_repeated_rows(spark):
    got = near_dedup.near_groups(frame(spark, [(4, "a b c d"), (4, "a b c d"), (2, "a b c d"), (9, "x")])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(2, 2, True), (4, 2, False), (4, 2, False), (9, 9, True)]


def test_near_chain_beyond_the_centre(spark):
    """Links between members of a band that the band's smallest class is not linked with."""
    words = [f"w{i}" for i in range(400)]
    chain = []
    for step in range(12):
        chain.append((step, " ".join(words)))
        for k in range(8):
            words[(step * 8 + k) * 4 % 400] = f"c{step}_{k}"
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(frame(spark, chain)).collect()}
    assert got == brute.near(chain)


def test_components_of_chain_and_star(spark):
    links = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 1000 for i in range(1000, 1200)}


def test_suffix(spark, rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == brute.repeats(rows)


def test_suffix_kept_bytes_and_hostile_ids(spark):
    a = "abcdefghij" * 10
    got = suffix_dedup.remove_repeats(frame(spark, [(1, a), (2, "x" + a + "y"), (2, "x" + a + "y"), (None, a), (None, None), (3, a), (3, "short")]), keep_bytes=True).collect()
    assert sorted((r.doc_id or 0, bytes(r.kept)) for r in got) == [
        (0, b""), (0, a.encode()), (1, a.encode()), (2, b"xy"), (2, b"xy"), (3, b""), (3, b"short")]


@pytest.mark.parametrize("seed", range(6))
def test_suffix_small_alphabets(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, "".join(rnd.choice("ab" if seed % 2 else "abcd") for _ in range(rnd.randrange(40, 200))) * rnd.choice([1, 1, 3])) for i in range(25)]
    rows += [(100 + i, rows[i][1][10:] + "e" + rows[i + 1][1][:90]) for i in range(20)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == brute.repeats(rows)


def test_leaks(spark):
    rnd = random.Random(1)
    items = [(i, prose(rnd, rnd.randrange(20, 60), 3000)) for i in range(12)] + [(20, "tiny one"), (21, ""), (22, None), (23, "Single")]
    docs = [(0, None), (1, ""), (2, "tiny"), (3, "a Tiny, ONE here"), (4, prose(rnd, 30_000, 3000)), (5, "single")]
    for i in range(60):
        words = items[i % 12][1].split()
        for _ in range(i // 12):
            at = rnd.randrange(len(words))
            words[at : at + rnd.randrange(2)] = ["new"] if i % 2 else []
        docs.append((100 + i, prose(rnd, rnd.randrange(5, 50), 3000) + " " + " ".join(words).upper() + "! " + prose(rnd, rnd.randrange(0, 50), 3000)))
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(frame(spark, [*docs, docs[20], (None, items[0][1])]), bench).collect()}
    want = brute.leaks(docs, items)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_leaks_between_alignments(spark):
    rnd = random.Random(5)
    items = [(i, prose(rnd, 35 + 2 * i, 3000)) for i in range(12)]
    docs = []
    for i, text in items:
        words = text.split()
        half = len(words) // 2 + i % 3
        docs.append((i, f"{prose(rnd, 60, 3000)} {' '.join(words[half:] + words[:half])} {prose(rnd, 30, 3000)}"))
        third = words[half:] + ["new"] + words[:half]
        docs.append((100 + i, " ".join([*third, *words[half:], prose(rnd, 9, 3000)])))
    want = brute.leaks(docs, items)
    assert len(want) > 12
    found = decontaminate.leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in found}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert any(r.n_windows == 0 for r in found)


def test_leaks_of_documents_shorter_than_the_item(spark):
    rnd = random.Random(6)
    items = [(i, prose(rnd, n, 3000)) for i, n in enumerate([7, 15, 20, 40, 59])]
    docs, want = [], {}
    for i, text in items:
        words = text.split()
        shingles = brute.Counter(zip(*(words[k:] for k in range(5))))
        inner = len(words) // 2
        for j, part in enumerate([words[:-1], words[1:], words[2:-1], words[:inner] + words[inner + 1:], words[: len(words) * 2 // 3]]):
            docs.append((10 * i + j, " ".join(part)))
            got = brute.Counter(zip(*(part[k:] for k in range(5))))
            common = sum((shingles & got).values())
            value = common / (sum(shingles.values()) + sum(got.values()) - common)
            if value >= 0.8:
                want[10 * i + j, i] = value
    assert {i for _, i in want} == {1, 2, 3, 4} and (43, 4) in want
    found = decontaminate.leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in found}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    left = decontaminate.drop_leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_leaks_far_apart_in_bits(spark):
    rnd = random.Random(8)
    items = [(i, prose(rnd, 9, 3000)) for i in range(200)]
    docs = [(i, text.rsplit(" ", 1)[0]) for i, text in items]  # four of five shingles: 24 of 128 bits differ on average
    found = decontaminate.leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i) for i, _ in items}


def test_fingerprint_is_the_majority_of_bits(spark):
    rnd = random.Random(3)
    lists = [[f"s{rnd.randrange(n)}" for _ in range(n)] for n in (1, 2, 5, 55, 126, 127, 128, 300)] + [["same"] * 127, ["same"] * 128]
    df = spark.createDataFrame([(x,) for x in lists], "s array<string>")
    for r in df.select("s", decontaminate.fingerprint("s", 1).alias("got"), F.expr("transform(s, x -> xxhash64(1, x))").alias("hashes")).collect():
        want = sum((2 * sum(h >> b & 1 for h in r.hashes) > len(r.hashes)) << b for b in range(64))
        assert r.got % 2**64 == want


def test_blocks_hold_every_bit_once(spark):
    bits = spark.range(128).selectExpr("if(id < 64, shiftleft(1L, cast(id as int)), 0L) as low", "if(id < 64, 0L, shiftleft(1L, cast(id - 64 as int))) as high")
    none = spark.range(1).selectExpr("0L as low", "0L as high").select(decontaminate.blocks_of("low", "high")).first()[0]
    got = [r[0] for r in bits.select(decontaminate.blocks_of("low", "high")).collect()]
    assert len(none) == decontaminate.BLOCKS == decontaminate.RADIUS + 1
    assert all(sum(a != b for a, b in zip(x, none)) == 1 for x in got) and len(set(map(tuple, got))) == 128


def test_empty_tables(spark):
    none = frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    assert exact_dedup.exact_groups(none).count() == 0
    assert near_dedup.near_groups(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert decontaminate.leaks(none, items).count() == 0
    assert decontaminate.leaks(frame(spark, [(1, "a b c")]), items).count() == 0
    assert decontaminate.drop_leaks(frame(spark, [(1, "a b c")]), items).count() == 1
