"""The pipeline against plain versions of its stages, and the registered queries."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from roadpulse.llm import language  # noqa: E402
from roadpulse.llm.bpe_tree import codec  # noqa: E402


def test_stages_against_plain_versions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    model = language.fit(docs.filter(~language.held_out()))
    found = language.Labeller(model)
    left = []
    for r in docs.collect():
        lang, score, _ = found([r.text or ""])[0]
        if lang != "und" and score >= corpus_pipeline.LEAST_LANGUAGE_SCORE:
            left.append((r.doc_id, r.text))
    groups = brute.exact(left)
    left = [(d, t) for d, t in left if groups[d][2]]
    near = brute.near(left, corpus_pipeline.NEAR_SHINGLE, corpus_pipeline.NEAR_PERCENT)
    left = [(d, t) for d, t in left if near[d][1] == d]
    leaked = {d for d, _ in brute.leaks(left, items)}
    want = {}
    for d, t in left:
        if d not in leaked:
            ids, decoded = codec(None)([t or ""])[0]
            want[d] = len(ids) // 4, brute.sha(ids), brute.sha(decoded.encode())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, sf).collect()} == want


def test_stages_keep_columns_and_accept_empty_and_hostile_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(None, None, None, None, None, 1), (-1, "", "en", "s", 0, 1), (-2, "word " * 20_000, None, None, None, 1), (-3, "just words here", "en", "s", 3, 1)]
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int")
    for table in (docs.limit(0), extra, docs.selectExpr("*", "1 as kept", "2 as component", "3 as __x").limit(60)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, sf).columns == table.columns
            stage(spark, table, sf).count()


@pytest.mark.parametrize("n", range(1, 14))
def test_every_operator_is_registered(n):
    assert sum(name.startswith(f"op{n}_") for name in entry.queries()) == 1
