"""Document fingerprints by consistent weighted sampling. Built-in functions only.

The terms of a text are its words, lower-cased, each weighted by how often it occurs. For every sample i a term draws from
its own hash two gamma(2, 1) numbers r and c and a uniform b. A weight w is lowered to the next step exp(r (t - b)),
t = floor(ln w / r + b), and the term's value is c / exp(r (t - b + 1)); the term of least value, with its t, is sample i.
Equal terms meet in two texts with the chance that their weights have in common, so the share of equal samples estimates
sum of lesser over sum of greater weights, the generalised Jaccard similarity.

Values are compared as ln(value) in steps of 2^-24, with 32 bits of the hash of (term, t) below, as one 64-bit number: a
sample is the minimum of a fixed-width column. Texts are shuffled once, by document; terms and samples of a document are
then grouped where they lie, so a text of any length is partial sums and minima only.

Most values are never worked out. A value is at least c exp(-r) / w, which products of the uniform numbers bound from below
without a logarithm; the least value of a text of n words is above ``FAR`` / n once in e^FAR samples. Terms whose bound is
above are passed over, and a text with a sample above (or none) is worked out again without the bound, so results are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranked, stored

#: Samples of a fingerprint, four hexadecimal digits each; how many of them a row of terms works out at a time.
SAMPLES, AT_ONCE = 64, 4
#: A sample is looked for among values up to ``FAR`` by the words of the text.
FAR = 16.0
BLANKS = r"[\x20\x09-\x0D]+"
LOW = "4294967295L"


def words_of(text: Column) -> Column:
    """Lower-cased words between ASCII blanks; a text without any is the one empty word."""
    return F.split(F.regexp_replace(F.lower(text), rf"^{BLANKS}|{BLANKS}$", ""), BLANKS)


def term_counts(texts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, n0, n1, ..., term, w0, w1, ...): the words of each of the text columns and how often each occurs; terms are 64-bit hashes of words.

    ``texts`` is distributed by (a part of) the keys; the rows of a text are counted there.
    """
    split = texts.select(*keys, *[words_of(F.col(c)).alias(f"words{i}") for i, c in enumerate(columns)])
    ends = ["0"]
    for i in range(len(columns)):
        ends.append(f"{ends[-1]} + size(words{i})")
    sizes = [f"n{i}" for i in range(len(columns))]
    every = split.select(*keys, *[F.size(f"words{i}").cast("long").alias(n) for i, n in enumerate(sizes)], *[F.expr(e).alias(f"end{i}") for i, e in enumerate(ends)], F.posexplode(
        F.concat(*[F.col(f"words{i}") for i in range(len(columns))])).alias("place", "word"))
    inside = [F.count_if((F.col("place") >= F.col(f"end{i}")) & (F.col("place") < F.col(f"end{i + 1}"))).alias(f"w{i}") for i in range(len(columns))]
    return every.groupBy(*keys, *sizes, F.xxhash64("word").alias("term")).agg(*inside)


def sampled(terms: DataFrame, keys: list[str], weights: int, samples: int, far: float | None = FAR) -> DataFrame:
    """(keys, fingerprint0, fingerprint1, ..., whole) of terms weighted by ``w0``, ``w1``, ...; weight 0 means absent.

    Terms whose bound is above ``far`` by the words of the text are left out (None: none is); where that could have changed a
    fingerprint ``whole`` is false.
    """
    sizes, each = [f"n{i}" for i in range(weights)], range(AT_ONCE)
    limit = " , ".join(["0D", *[f"w{i} / n{i}" for i in range(weights)]])
    rows = terms.select(*keys, *sizes, "term", *[F.expr(f"ln(w{i})").alias(f"ln{i}") for i in range(weights)],
                        F.expr(f"{far if far is not None else 0}D * greatest({limit})").alias("limit"),
                        F.explode(F.sequence(F.lit(0), F.lit(samples // AT_ONCE - 1))).alias("block"))
    kept = [*keys, *sizes, "block", "term", *[f"ln{i}" for i in range(weights)]]
    rows = rows.select(*kept, "limit", *[F.expr(f"xxhash64(term, block * {AT_ONCE} + {k})").alias(f"a{k}") for k in each])
    rows = rows.select(*kept, "limit", *[f"a{k}" for k in each], *[F.expr(f"xxhash64(a{k}, 1)").alias(f"b{k}") for k in each])

    def product(x: str) -> str:
        return f"((({x} & {LOW}) + 0.5D) / 4294967296D) * ((shiftrightunsigned({x}, 32) + 0.5D) / 4294967296D)"

    rows = rows.select(*kept, "limit", *[f"b{k}" for k in each], *[F.expr(product(f"{x}{k}")).alias(f"{x}{x}{k}") for k in each for x in "ab"])
    drawn = []
    for k in each:  # -ln z is at least 2 (1 - z) / (1 + z); what is passed over is null from here on
        near = f"2D * (1D - bb{k}) * aa{k} <= limit * (1D + bb{k})" if far is not None else "true"
        drawn.append(F.expr(f"if({near}, aa{k}, null)").alias(f"aa{k}"))
    rows = rows.select(*kept, *drawn, *[x for k in each for x in (f"b{k}", f"bb{k}")])
    rows = rows.select(*kept, *[c for k in each for c in (
        F.expr(f"-ln(aa{k})").alias(f"r{k}"), F.expr(f"if(aa{k} is null, null, ln(-ln(bb{k})))").alias(f"c{k}"),
        F.expr(f"if(aa{k} is null, null, shiftrightunsigned(xxhash64(b{k}, 2), 11) / 9007199254740992D)").alias(f"u{k}"))])
    rows = rows.select(*kept, *[c for k in each for c in (f"r{k}", f"c{k}", f"u{k}")],
                       *[F.expr(f"floor(ln{i} / r{k} + u{k})").alias(f"t{i}_{k}") for i in range(weights) for k in each])

    def packed(i: int, k: int) -> Column:
        value = f"cast(floor((c{k} - r{k} * (t{i}_{k} - u{k} + 1)) * 16777216D) as bigint)"
        return F.expr(f"min(shiftleft({value}, 32) | (xxhash64(term, t{i}_{k}) & {LOW}))").alias(f"s{i}_{k}")

    least = rows.groupBy(*keys, *sizes, "block").agg(*[packed(i, k) for i in range(weights) for k in each])
    digits = [F.concat(*[F.lpad(F.lower(F.hex(F.col(f"s{i}_{k}").bitwiseAND(65535))), 4, "0") for k in each]).alias(f"part{i}") for i in range(weights)]
    # a value below the limit by more than rounding is below all that were passed over
    sure = [f"coalesce(shiftright(s{i}_{k}, 32) < floor((ln({far}D / n{i}) - 0.00001D) * 16777216D), false)" for i in range(weights) for k in each]
    whole = F.expr(" and ".join(sure) if far is not None else "true").alias("whole")
    parts = least.select(*keys, "block", whole, *digits)
    return parts.groupBy(*keys).agg(F.bool_and("whole").alias("whole"), *[
        F.array_join(F.array_sort(F.collect_list(F.struct("block", f"part{i}"))).getField(f"part{i}"), "").alias(f"fingerprint{i}")
        for i in range(weights)])


def exactly(texts: Callable[[DataFrame | None], DataFrame], keys: list[str], columns: list[str], samples: int, far: float | None) -> DataFrame:
    """Stored fingerprints (keys, fingerprint0, ...) of the text columns; ``texts`` gives the rows, all or those of some keys."""
    def made(some: DataFrame | None, far: float | None) -> DataFrame:
        return stored(sampled(term_counts(texts(some), keys, columns), keys, len(columns), samples, far), "fingerprints")

    first = made(None, far)
    sure, unsure = first.filter("whole"), first.filter("not whole").select("key")
    return (sure.union(made(unsure, None)) if far is not None and unsure.head(1) else sure).drop("whole")


def likeness(a: str, b: str) -> Column:
    """Share of equal samples of two fingerprints."""
    return F.expr(f"size(filter(sequence(1, length({a}), 4), i -> substring({a}, i, 4) = substring({b}, i, 4))) / (length({a}) / 4)")


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, key): null text as empty; the key is a digest of id and text, the same for repeated rows only."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("key", F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.col("text")), 256)))


def some_of(rows: DataFrame, keys: DataFrame | None) -> DataFrame:
    return rows if keys is None else rows.join(keys, "key", "left_semi")


def fingerprints(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text", far: float | None = FAR) -> DataFrame:
    """One row per document: doc_id, fingerprint (four hexadecimal digits for each of ``samples``, a multiple of 4).

    Equal texts have equal fingerprints, and so have texts with the same words equally often. Null text counts as empty; texts
    without words have all the same one. Repeated rows give repeated results.
    """
    rows = identified(docs, id_col, text_col)
    ids = stored(rows.select("doc_id", "key"), "ids")
    made = exactly(lambda some: some_of(rows, some).repartition("key").select("key", "text").distinct(), ["key"], ["text"], samples, far)
    return ids.join(made, "key").select("doc_id", F.col("fingerprint0").alias("fingerprint"))


def compare_edits(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text", far: float | None = FAR) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last quarter of its code points (rounded down) replaced by as many first ones of the next document,
    or by all that it has. Documents follow each other by id (null first), then by a digest of id and text; the first follows
    the last, so a single document follows itself. Null text counts as empty. Repeated rows are one document with repeated
    results. A very long text is one row until it is cut into words. Without rows there is no result. Columns of other names
    are not read.
    """
    rows = identified(docs, id_col, text_col)
    ids = stored(rows.select("doc_id", "key", F.char_length("text").cast("long").alias("n_chars")), "ids")
    order = ranked(ids.distinct().select(F.lit("").alias("grp"), "key", "n_chars", "doc_id", F.col("key").alias("digest")), ["doc_id", "digest"])
    order = stored(order.select("key", "n_chars", "at", ((F.col("at") + 1) % F.col("n")).alias("then")), "order")
    follow = stored(order.select("key", "n_chars", F.col("then").alias("at")).join(
        order.select("at", F.col("key").alias("next_key")), "at").select("key", "n_chars", "next_key"), "follow")

    quarter = F.floor(F.col("n_chars") / 4).cast("int")

    def edited(some: DataFrame | None) -> DataFrame:
        links = some_of(follow, some)
        givers = None if some is None else links.select(F.col("next_key").alias("key")).distinct()
        given = some_of(rows.select("key", "text"), givers).repartition("key").join(links.select(F.col("next_key").alias("key"), F.col("key").alias("to"), quarter.alias("most")), "key").select(
            F.col("to").alias("key"), F.expr("left(text, most)").alias("start")).repartition("key").distinct()
        own = some_of(rows.select("key", "text"), some).repartition("key").distinct().join(links.select("key", "n_chars"), "key")
        both = own.join(given, "key").select("key", "text", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - quarter).cast("int")), "start").alias("edited"))
        return both.withColumn("edited_sha256", F.unhex(F.sha2("edited", 256)))

    made = exactly(edited, ["key", "edited_sha256"], ["text", "edited"], samples, far)
    after = made.select(F.col("key").alias("next_key"), F.col("fingerprint0").alias("following"))
    result = made.join(follow, "key").join(after, "next_key").select(
        "key", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), F.col("fingerprint0").alias("fingerprint"), F.col("fingerprint1").alias("edited_fingerprint"),
        likeness("fingerprint0", "fingerprint1").alias("near_edited"), likeness("fingerprint0", "following").alias("near_next"))
    return ids.join(result, "key").select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
