"""Registered queries of this subpackage, each over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_tree, chat, decontaminate, exact_dedup, fingerprint, html_text, language, merkle, near_dedup, phrases, secret_scan, suffix_dedup, token_counts

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


ORACLES["op1_exact_dedup"] = r"""
with rows as (
  select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as bare
  from documents),
classes as (
  select bare, count(*) as group_size, arg_min(doc_id, (-n, doc_id)) as keep_id from rows group by bare)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(bare) as text_sha256
from rows join classes using (bare)
"""


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.encode_digests(table(spark, sf_dir, "documents"))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans")


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op9_decontaminate"] = r"""
with doc_words as (
  select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') as words from documents),
item_words as (
  select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') as words from benchmark),
items as (select item_id, words, len(words) as words_in, least(len(words), 5) as q from item_words where len(words) > 0),
doc_shingles as (
  select doc_id, i as pos, array_to_string(words[i:i + q - 1], ' ') as shingle, q
  from doc_words, (select distinct q from items), unnest(range(1, len(words) - q + 2)) as r(i)),
item_shingles as (
  select item_id, words_in, q, i as pos, array_to_string(words[i:i + q - 1], ' ') as shingle
  from items, unnest(range(1, len(words) - q + 2)) as r(i)),
item_weights as (select item_id, words_in, q, shingle, count(*) as n from item_shingles group by all),
windows as (
  select distinct doc_id, d.q, words_in, least(greatest(d.pos - i.pos, 0), len(words) - words_in) + 1 as first
  from doc_shingles d join item_shingles i using (shingle, q) join doc_words using (doc_id)
  where len(words) >= words_in),
window_weights as (
  select doc_id, words_in, q, first, shingle, count(*) as n
  from windows join doc_shingles using (doc_id, q) where pos between first and first + words_in - q group by all),
common as (
  select doc_id, w.words_in, first, item_id, sum(least(w.n, i.n)) as c, any_value(w.words_in - w.q + 1) as m
  from window_weights w join item_weights i using (words_in, q, shingle) group by all)
select doc_id, item_id, max(c / (2 * m - c)) as similarity, count(*) as n_windows
from common where c / (2 * m - c) >= 0.8 group by doc_id, item_id
"""


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~language.held_out()))
    return language.identify(docs, model).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "spans")


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    held_out = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % 3 == 1, F.lit(False))
    hmm = chat.fit(turns.filter(~held_out))
    return chat.format_turns(turns, hmm).withColumn("held_out", held_out)


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    every_third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.verify(table(spark, sf_dir, "documents"), {"text": F.translate("text", upper, upper.lower())}, every_third)


ORACLES["op11_merkle_manifest"] = r"""
with recursive docs as (
  select row_number() over (order by doc_id) as line, *,
    list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(doc_id::varchar, ''), lambda c:
      list_concat([ord(c)::bigint], list_value(-1, -1, -1, -1, -1, -1, -1, -1))))), lambda crc, x: case when x >= 0 then xor(crc, x)
      when crc % 2 = 1 then xor(crc // 2, 3988292384) else crc // 2 end) as crc,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered
  from documents),
hashed as (
  select line, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    case when xor(crc, 4294967295) % 3 = 0 then sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) end as changed
  from (select *, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head from docs)),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf, line) - 1 as pos, count(*) over (partition by lang) as n from hashed),
below as (
  select 0 as level, lang, pos, n, leaf as node from leaves
  union all
  select level + 1, lang, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' order by pos)) from below where n > 1 group by level, lang, pos // 8, n),
tops as (
  select lang, node as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from below where n = 1),
above as (
  select 0 as level, pos, n, subroot as node from tops
  union all
  select level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' order by pos)) from above where n > 1 group by level, pos // 8, n),
runs as (
  select false as upper, level, lang, pos // 8 as up, list(node order by pos) as nodes from below where n > 1 group by level, lang, pos // 8
  union all
  select true, level, null, pos // 8, list(node order by pos) from above where n > 1 group by level, pos // 8),
walk as (
  select l.line, false as upper, 0 as level, l.lang, l.pos, l.n, coalesce(changed, leaf) as value, '' as proof, t.pos as top_at, t.n as top_n
  from leaves l join tops t on l.lang is not distinct from t.lang
  union all
  select line, w.upper or w.n = 1, case when w.n = 1 then 0 else w.level + 1 end, case when w.n > 1 then w.lang end, case when w.n = 1 then top_at else w.pos // 8 end,
    case when w.n = 1 then top_n else (w.n + 7) // 8 end,
    case when w.n = 1 then value else sha256(array_to_string(list_concat(nodes[:w.pos % 8], [value], nodes[w.pos % 8 + 2:]), '')) end,
    case when w.n = 1 then proof else proof || array_to_string(list_concat(nodes[:w.pos % 8], nodes[w.pos % 8 + 2:]), '') end, top_at, top_n
  from walk w left join runs r on r.upper = w.upper and r.level = w.level and r.lang is not distinct from w.lang and r.up = w.pos // 8
  where w.n > 1 or not w.upper)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, value as folded_root, value = root as verified
from walk join leaves using (line) join tops t on leaves.lang is not distinct from t.lang
cross join (select node as root from above where n = 1) where walk.upper and walk.n = 1
"""


@query
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(table(spark, sf_dir, "documents"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
word_lists as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as words from pieces),
runs as (
  select lang, k, array_to_string(words[i:i + k - 1], ' ') as phrase
  from word_lists, unnest([1, 2, 3]) as s(k), unnest(range(1, len(words) - k + 2)) as p(i)),
counts as (select lang, phrase, any_value(k) as k, count(*) as f from runs group by lang, phrase),
totals as (select lang, sum(f)::bigint as n from counts where k = 1 group by lang),
found as (select lang, phrase, k, f as a, string_split(phrase, ' ') as words from counts where k > 1 and f >= 10),
cuts as (
  select lang, phrase, a, cut, array_to_string(words[:cut], ' ') as head, array_to_string(words[cut + 1:], ' ') as tail
  from found, unnest(range(1, k)) as c(cut)),
scored as (
  select c.lang, c.phrase, c.a, cut, x.f as l, y.f as r, 1000000::hugeint * c.a * c.a // (x.f::hugeint * y.f) as score
  from cuts c join counts x on x.lang = c.lang and x.phrase = c.head join counts y on y.lang = c.lang and y.phrase = c.tail),
best as (
  select lang, phrase, any_value(a) as a, min(score)::bigint as score, arg_min(l, (score, cut)) as l, arg_min(r, (score, cut)) as r
  from scored group by lang, phrase),
inside as (
  select lang, array_to_string(words[i:i + 1], ' ') as phrase, max(a) as longer from found, unnest([1, 2]) as s(i) where k = 3 group by all),
kept as (
  select b.*, row_number() over (partition by b.lang order by score desc, a desc, b.phrase) as rank
  from best b left join inside i on i.lang = b.lang and i.phrase = b.phrase where i.longer is null or 100 * i.longer < 50 * a)
select lang, rank, phrase, a, l, r, n, score from kept join totals using (lang) where rank <= 2000
"""
