"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

Built-in functions only. A window has as many words as a benchmark item and may start anywhere in the text. One that reaches
the similarity has so many shingles of items of its size that a count of them tells it apart beforehand; windows with fewer
can't reach it, so leaving them out loses nothing. A document with fewer words than an item is one window. Every window left gets a 128-bit SimHash of its
weighted shingles (weight: how often a shingle occurs in it). The fingerprints are cut into 43 blocks of 3 bits (the last
has 2); of two that differ in at most 42 bits at least one block is equal, so a join on (window size, block number, block)
finds all items within that radius. It lies five deviations above the mean at similarity 0.8. Blocks of 3 bits alone would
let most pairs meet, so the key also holds one of the first shingles in hash order: two lists that reach the similarity
share one of these, which is exact. Pairs within the radius are then compared exactly: sum of lesser over sum of greater
weights of the shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, stored, without

SHINGLE, SIMILARITY = 5, 0.8
BLOCKS, BLOCK_BITS, RADIUS = 43, 3, 42
#: Bits that say which texts may hold a window.
MARKS = 1 << 22


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column, size: Column) -> Column:
    """All runs of ``size`` words as strings, in order, with repeats; ``size`` is 1 to ``SHINGLE`` and at most the words."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.array_join(F.slice(words, i + 1, size), " "))


def fingerprint(shingles: str, seed: int) -> Column:
    """64 bits: bit b is set when it is set in more than half of the shingles, each counted as often as it occurs.

    Up to 127 shingles eight numbers hold eight counts of a byte each; longer lists are counted bit by bit.
    """
    def counted(zeros: str, step: str, count: str) -> str:
        return f"""aggregate(transform({shingles}, s -> xxhash64({seed}, s)), {zeros}, (n, h) -> {step},
            n -> aggregate(sequence(0, 63), 0L, (bits, b) -> bits | shiftleft(cast({count} * 2 > size({shingles}) as bigint), b)))"""

    packed = counted("array_repeat(0L, 8)", f"transform(sequence(0, 7), j -> n[j] + (shiftrightunsigned(h, j) & {0x0101010101010101}L))",
                     "(shiftrightunsigned(n[b % 8], b - b % 8) & 255L)")
    plain = counted("array_repeat(0, 64)", "zip_with(n, sequence(0, 63), (x, b) -> x + cast(shiftrightunsigned(h, b) & 1L as int))", "n[b]")
    return F.expr(f"if(size({shingles}) <= 127, {packed}, {plain})")


def blocks_of(low: str, high: str) -> Column:
    """(block number, value) packed in one integer, for all blocks of both halves; the last block is the top bit of each."""
    half, values = BLOCKS // 2, 1 << BLOCK_BITS
    return F.expr(f"""concat(transform(sequence(0, {2 * half - 1}), i -> i * {values} + cast(
        shiftrightunsigned(if(i < {half}, {low}, {high}), {BLOCK_BITS} * (i % {half})) & {values - 1}L as int)),
        array({2 * half * values} + cast(2 * shiftrightunsigned({low}, 63) + shiftrightunsigned({high}, 63) as int)))""")


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of lesser over sum of greater weights, a shingle's weight being how often it occurs."""
    def times(of: Column, s: Column) -> Column:
        return F.size(F.filter(of, lambda x: x == s))

    common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, s: n + F.least(times(a, s), times(b, s)))
    return common / (F.size(a) + F.size(b) - common)


def early(shingles: str, n: Column) -> Column:
    """The distinct hashes among the ``n`` least, counted with repeats: two lists of ``a`` and ``b`` shingles with ``c`` or more in
    common share one of their ``a - c + 1`` and ``b - c + 1`` least."""
    return F.array_distinct(F.slice(F.array_sort(F.transform(shingles, lambda s: F.xxhash64(s))), F.lit(1), n))


def keys_of(hashes: Column, blocks: Column) -> Column:
    """One key for each pair of an early shingle and a block."""
    return F.flatten(F.transform(hashes, lambda h: F.transform(blocks, lambda b: F.xxhash64(h, b))))


def least_common(a: Column, b: Column, similarity: float) -> Column:
    """Shingles that two lists of ``a`` and ``b`` shingles have in common at least, if they reach the similarity."""
    return F.greatest(F.ceil((a + b) * (similarity / (1 + similarity)) - 1e-6), F.lit(1)).cast("int")


def starts_with_hits() -> Column:
    """All starts of windows of ``m`` shingles that hold ``need`` or more of the places ``ats``, each once.

    Entry i of the list is the first place in the window, so the start lies behind the place before and not behind i; the
    window ends at place i + need - 1 or later.
    """
    return F.expr("""flatten(transform(filter(transform(sequence(0, size(ats) - need), i -> struct(
        greatest(0, if(i > 0, ats[i - 1] + 1, 0), ats[i + need - 1] - m + 1) as low, least(ats[i], n - width) as high)),
        r -> r.low <= r.high), r -> sequence(r.low, r.high)))""")


def shingles_of_window() -> Column:
    """The shingles of ``window_text``, words with a blank between; a list goes over its words, so they are cut once."""
    words = F.array(F.split("window_text", " "))
    return F.get(F.transform(words, lambda w: shingles_of(w, F.least("words_in", F.lit(SHINGLE)))), F.lit(0))


def marked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose bit of ``MARKS`` is set by a (doc_id, digest) of ``wanted``: all that are wanted, and few others.

    The bits are words of a table of fixed size, which every task gets, so no other row is dealt out for the exact join.
    """
    bit = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(MARKS))
    mask = F.expr("shiftleft(1L, cast(__bit & 63 as int))")
    table = wanted.select("doc_id", "digest").withColumn("__bit", bit).groupBy(F.shiftright("__bit", 6).alias("__word")).agg(F.bit_or(mask).alias("__mask"))
    placed = rows.withColumn("__bit", bit).withColumn("__word", F.shiftright("__bit", 6))
    return placed.join(F.broadcast(table), "__word").filter(F.col("__mask").bitwiseAND(mask) != 0).select(*rows.columns)


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, similarity (the best window's), n_windows.

    All windows count for what is found and for the similarity. Of the windows that reach the threshold, n_windows counts
    those where a shared shingle lies at the same place as in an item; it is 0 where only others do.

    Items shorter than five words are one shingle of their length; items and texts without words match nothing, as do null
    texts. A document shorter than an item is compared as a whole. Rows without an id are read but never reported; repeated
    documents are one, and repeated items give the same rows once. Unlike texts of one id are searched one by one and
    reported together. Very long texts are searched as a whole.
    """
    found = _found(docs, benchmark, similarity, id_col, text_col, item_col, item_text_col)
    return found.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), F.sum("n_windows").alias("n_windows"))


def _found(docs: DataFrame, benchmark: DataFrame, similarity: float, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """One row per document, window text and item that reach the similarity, with ``digest``, a hash of the document's text."""
    items = benchmark.select(F.col(item_col).alias("item_id"), words_of(F.coalesce(F.col(item_text_col), F.lit(""))).alias("words"))
    items = items.filter((F.size("words") > 0) & F.col("item_id").isNotNull()).select(
        "item_id", F.size("words").alias("words_in"), F.least(F.size("words"), F.lit(SHINGLE)).alias("q"), "words")
    items = items.withColumn("item_shingles", shingles_of(F.col("words"), F.col("q"))).drop("words").distinct()
    items = stored(items.withColumn("item", F.monotonically_increasing_id()).withColumn("low", fingerprint("item_shingles", 1)).withColumn("high", fingerprint("item_shingles", 2)), "items")
    anchors = items.select("words_in", "q", F.posexplode("item_shingles").alias("at_item", "shingle")).select(
        "q", F.xxhash64("shingle").alias("h"), F.struct("words_in", "at_item").alias("place")).distinct()
    anchors = stored(anchors.groupBy("h", "q").agg(F.collect_set("place").alias("places")), "anchors")

    texts = id_and_text(docs, id_col, text_col).filter("doc_id is not null").withColumn("digest", F.xxhash64("text"))
    rows = texts.select("doc_id", "digest", words_of(F.col("text")).alias("words"))
    sizes = [r["q"] for r in items.select("q").distinct().collect()] or [SHINGLE]  # at most five
    def hashed(q: int) -> Column:
        """(hash, size, place) of all runs of q words; none where the text is shorter."""
        last = F.size("words") - q
        runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
            F.xxhash64(F.concat_ws(" ", *[F.get("words", i + k) for k in range(q)])).alias("h"), F.lit(q).alias("q"), i.alias("at")))
        return F.when(last >= 0, runs).otherwise(F.array().cast("array<struct<h:bigint,q:int,at:int>>"))

    hashes = F.flatten(F.array(*[hashed(q) for q in sizes])) if len(sizes) > 1 else hashed(sizes[0])
    places = rows.select("doc_id", "digest", F.size("words").alias("n"), F.inline(hashes)).join(anchors, ["h", "q"]).select(
        "doc_id", "digest", "n", F.explode("places").alias("place"), "at")
    width = F.least(F.col("n"), F.col("place.words_in"))
    start = F.least(F.greatest(F.col("at") - F.col("place.at_item"), F.lit(0)), F.col("n") - width)
    hits = places.groupBy("doc_id", "digest", "n", F.col("place.words_in").alias("words_in"), width.alias("width")).agg(
        F.array_sort(F.collect_set("at")).alias("ats"), F.collect_set(start).alias("aligned"))
    size = F.least(F.col("words_in"), F.lit(SHINGLE))
    hits = hits.withColumn("m", F.col("width") - size + 1)
    hits = hits.withColumn("need", least_common(F.col("m"), F.col("words_in") - size + 1, similarity)).filter("size(ats) >= need")
    spans = hits.select("doc_id", "digest", "words_in", "aligned", F.explode(starts_with_hits()).alias("start"))
    spans = stored(spans.select("doc_id", "digest", "words_in", "start", F.array_contains("aligned", F.col("start")).alias("aligned")), "spans")

    # Texts are joined, not their words, and only those that a table of bits of fixed size lets through: else all texts
    # would be dealt out and sorted as arrays of words. A window goes on as its words in one string until it is compared.
    hit = spans.select("doc_id", "digest").distinct()
    held = marked(texts, hit).join(hit, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"])
    held = held.select("doc_id", "digest", words_of(F.col("text")).alias("words"))
    windows = spans.join(held, ["doc_id", "digest"]).select("doc_id", "digest", "words_in", "aligned", F.array_join(
        F.slice("words", F.col("start") + 1, F.col("words_in")), " ").alias("window_text"))
    windows = windows.groupBy("doc_id", "digest", "words_in", "window_text").agg(F.count_if("aligned").alias("n_windows"))
    # Few bytes, much work: rows are spread over all tasks, whatever the size of their files.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    windows = windows.repartition(tasks, "doc_id", "digest", "window_text").withColumn("window", F.monotonically_increasing_id())
    windows = windows.withColumn("shingles", shingles_of_window())
    windows = stored(windows.withColumn("low", fingerprint("shingles", 1)).withColumn("high", fingerprint("shingles", 2)).drop("shingles"), "windows")

    # Narrow rows meet on (size, early shingle, block); what is within the radius is listed once and gets its shingles back.
    shingled = windows.select("window", "words_in", "low", "high", shingles_of_window().alias("shingles"))
    m, of_item = F.size("shingles"), F.col("words_in") - F.least(F.col("words_in"), F.lit(SHINGLE)) + 1
    w = shingled.select("window", "words_in", F.col("low").alias("w_low"), F.col("high").alias("w_high"), F.explode(
        keys_of(early("shingles", m - least_common(m, of_item, similarity) + 1), blocks_of("low", "high"))).alias("key"))
    i = items.select("item", "words_in", "low", "high", F.explode(
        keys_of(early("item_shingles", of_item - F.ceil(of_item * similarity - 1e-6).cast("int") + 1), blocks_of("low", "high"))).alias("key"))
    apart = F.bit_count(F.col("low").bitwiseXOR(F.col("w_low"))) + F.bit_count(F.col("high").bitwiseXOR(F.col("w_high")))
    near = w.join(i, ["words_in", "key"]).filter(apart <= RADIUS).select("window", "item").distinct()
    near = near.join(windows.drop("low", "high"), "window").repartition(tasks, "window", "item")
    near = near.join(items.select("item", "item_id", "item_shingles"), "item").withColumn("shingles", shingles_of_window())
    near = near.withColumn("similarity", weighted_similarity(F.col("shingles"), F.col("item_shingles")))
    near = stored(near.select("doc_id", "digest", "n_windows", "item_id", "similarity"), "near")
    return near.filter(F.col("similarity") >= similarity)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in which no item is found, with all their columns. Rows of one id with unlike texts are judged one by one."""
    found = _found(docs, benchmark, similarity, id_col, text_col, "item_id", "text")
    return without(docs, found.select(F.struct("doc_id", "digest").alias("__gone")), id_col, text_col)
