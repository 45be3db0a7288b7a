"""Benchmark decontamination by winnowing: every window of an item that a document repeats, word for word.

1. Every run of ``k`` words gets a hash; of the ``span`` hashes inside a window
   of ``window`` = k + span - 1 words the smallest is the window's fingerprint.
   Equal windows have equal fingerprints, so a shared run of ``window`` words
   or more can't be missed.
2. The documents' windows whose fingerprint some benchmark window has are found
   at the scan with a bit table of fixed size (TABLE_WORDS longs); false hits
   cost time only.
3. What is left is joined with the benchmark's windows on fingerprint and
   length, and the hit is extended: the whole window must be equal.
4. Overlapping windows are merged into spans of hit words. Documents with the
   same set of windows share one list of items, so a passage that many
   documents and many items hold isn't expanded into pairs of them.

Items of fewer words than ``window`` are one window each, of their own length;
documents are also cut into windows of those lengths that occur (fewer than
``window`` of them).

DataFrame and SQL functions only. Documents are read once; equal texts are
worked on once behind the bit table.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond
U+007F. A null or empty text has no words and no hits, and an item without words
no window. Very long texts are whole (their words are one array). Repeated rows
stay, each with its result. A null item id counts as the empty text; rows of
one item id are one item. Empty tables give no rows or no hits. Only the named
columns are read, so names of others don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

WINDOW = 10
#: Longs of the bit table of benchmark fingerprints (1 MB; 8.4 million bits); a power of two, 2 at least.
TABLE_WORDS = 1 << 17
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def gram(window: int) -> int:
    """Words of a k-gram for windows of this length: about half of it."""
    return (window + 2) // 2


def _worded(df: DataFrame, text: str, keep: Sequence[Column]) -> DataFrame:
    """``keep``, the words as written (__w), their number and hashes (__n, __h)."""
    cut = df.select(*keep, F.split(F.coalesce(F.col(text), F.lit("")), _GAPS).alias("__raw"))
    # Only the first and the last piece can be empty.
    head = (F.get("__raw", F.lit(0)) == "").cast("int")
    tail = ((F.size("__raw") > 1) & (F.element_at("__raw", -1) == "")).cast("int")
    names = [c for c in cut.columns if c != "__raw"]
    cut = cut.withColumns({"__head": head, "__tail": tail})
    inner = F.slice("__raw", F.col("__head") + 1, F.size("__raw") - F.col("__head") - F.col("__tail"))
    cut = cut.select(*names, inner.alias("__w"))
    # Lower-casing all letters here joins more windows than are equal; the extension tells them apart.
    return cut.select(*names, "__w", F.size("__w").alias("__n"), F.transform("__w", lambda w: F.xxhash64(F.lower(w))).alias("__h"))


def _starts(last: Column) -> Column:
    return F.sequence(F.lit(0), F.greatest(last, F.lit(0)))


def _over(array: str, size: int, fn):
    """``fn`` of the ``size`` entries from i on, as a function of i."""
    return lambda i: fn(*[F.get(array, i + j) for j in range(size)])


def _fingerprints(df: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """A column __f<length> each: the fingerprint of the window at every word; null with fewer words."""
    for length in lengths:
        k = gram(length)
        span = length - k + 1
        grams = F.transform(_starts(F.col("__n") - k), _over("__h", k, F.xxhash64))
        df = df.withColumn("__g", F.when(F.col("__n") >= length, grams))
        least = F.transform(_starts(F.size("__g") - span), _over("__g", span, F.least)) if span > 1 else F.col("__g")
        df = df.withColumn(f"__f{length}", F.when(F.col("__n") >= length, least)).drop("__g")
    return df


def _window_text(start: Column, length: Column) -> Column:
    """The window's words, lower-cased as defined, with single spaces between."""
    return F.translate(F.array_join(F.slice("__w", start + 1, length), " "), _UPPER, _LOWER)


def _slot(f: Column) -> tuple[Column, Column]:
    """Place of a fingerprint in the bit table: word and bit."""
    bits = TABLE_WORDS.bit_length() - 1
    word = F.shiftrightunsigned(f, 64 - bits).cast("int")
    return word, F.shiftrightunsigned(f, 58 - bits).bitwiseAND(F.lit(63)).cast("int")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """The windows of every item: item, length, f (fingerprint), words; stored."""
    items = _worded(benchmark, text, [F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item")]).where("__n > 0")
    items = items.withColumn("length", F.least(F.col("__n"), F.lit(window)))
    lengths = list(range(1, window + 1))
    # Each item has the fingerprints of one length only.
    items = _fingerprints(items, lengths).select(
        "item", "length", "__w", F.posexplode(F.element_at(F.array(*[f"__f{n}" for n in lengths]), F.col("length"))).alias("at", "f")
    )
    found = items.select("item", "length", "f", _window_text(F.col("at"), F.col("length")).alias("words")).distinct()
    return stored(found, "benchmark-windows")


def _bit_table(spark: SparkSession, windows: DataFrame) -> Column:
    """All fingerprints of ``windows`` as one array of TABLE_WORDS longs."""
    word, bit = _slot(F.col("f"))
    marked = windows.select(word.cast("bigint").alias("id"), F.expr("1L").alias("one"), bit.alias("bit"))
    bits = marked.groupBy("id").agg(F.bit_or(F.call_function("shiftleft", F.col("one"), F.col("bit"))).alias("bits"))
    dense = spark.range(TABLE_WORDS).join(bits, "id", "left").select("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    ordered = dense.agg(F.array_sort(F.collect_list(F.struct("id", "bits"))).alias("all"))
    return ordered.select(F.col("all.bits")).scalar()


def candidates(docs: DataFrame, windows: DataFrame, window: int = WINDOW, ids: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per document (length 0) and one per window that passes the bit table; stored.

    Columns: ``ids``, key_1 and key_2 (128 bits that name the text), n_words,
    length, at (first word), f, words.
    """
    spark = docs.sparkSession
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most ``window`` numbers
    body = F.coalesce(F.col(text), F.lit(""))
    keep = [*[F.col(f"`{c}`") for c in ids], F.xxhash64(body).alias("key_1"), F.xxhash64(F.lit("text"), body).alias("key_2")]
    cut = _fingerprints(_worded(docs, text, keep), lengths)
    # The first array stands for the document itself.
    families = F.array(F.array(F.lit(0).cast("bigint")), *[f"__f{n}" for n in lengths])
    names = [*[F.col(f"`{c}`") for c in ids], "key_1", "key_2", "__n", "__w"]
    cut = cut.select(*names, F.posexplode(families).alias("__family", "__fs"))
    cut = cut.select(*names, "__family", F.posexplode("__fs").alias("at", "f"))
    word, bit = _slot(F.col("f"))
    marked = F.getbit(F.get(_bit_table(spark, windows), word), bit) == 1
    length = F.element_at(F.array(*[F.lit(n) for n in [0, *lengths]]), F.col("__family") + 1)
    cut = cut.where((F.col("__family") == 0) | marked).withColumn("length", length)
    found = cut.select(
        *[F.col(f"`{c}`") for c in ids],
        "key_1",
        "key_2",
        F.col("__n").cast("bigint").alias("n_words"),
        "length",
        "at",
        "f",
        F.when(F.col("length") > 0, _window_text(F.col("at"), F.col("length"))).alias("words"),
    )
    return stored(found, "winnowed")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    ids: Sequence[str] = ("doc_id",),
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """Per row of ``docs``: ``ids``, n_words, n_hit, spans and items.

    spans: (first, past) word ranges inside windows that some item has too,
    merged and in order. items: ids of those items as text, sorted; both empty
    where nothing is hit.
    """
    windows = benchmark_windows(benchmark, window, item, text)
    found = candidates(docs, windows, window, ids, text)
    key = ["key_1", "key_2"]
    known = windows.select("length", "f", "words").distinct().withColumn("window", F.md5(F.concat_ws(" ", "length", "words")))
    hits = found.where("length > 0").select(*key, "length", "at", "f", "words").dropDuplicates([*key, "length", "at"])
    hits = stored(hits.join(known, ["length", "f", "words"]).select(*key, "length", "at", "window"), "window-hits")

    # Spans: a window that begins after all earlier ones have ended opens a new one.
    order = Window.partitionBy(*key).orderBy("at", "length")
    ended = F.max(F.col("at") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = hits.withColumn("__new", F.coalesce(F.col("at") > ended, F.lit(True)).cast("int"))
    opened = opened.withColumn("__span", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = opened.groupBy(*key, "__span").agg(F.min("at").alias("first"), F.max(F.col("at") + F.col("length")).alias("past"))
    spans = merged.groupBy(*key).agg(
        F.sum(F.col("past") - F.col("first")).cast("bigint").alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("first", "past"))).alias("spans"),
    )

    # Texts with the same windows have the same items.
    sets = hits.groupBy(*key).agg(F.array_sort(F.collect_set("window")).alias("__windows"))
    sets = sets.withColumn("__set", F.sha2(F.array_join("__windows", " "), 256))
    item_of = windows.select("item", F.md5(F.concat_ws(" ", "length", "words")).alias("window")).distinct()
    one = sets.groupBy("__set").agg(F.first("__windows").alias("__windows")).select("__set", F.explode("__windows").alias("window"))
    items = one.join(item_of, "window").groupBy("__set").agg(F.array_sort(F.collect_set("item")).alias("items"))
    per_text = spans.join(sets.select(*key, "__set"), key).join(items, "__set").drop("__set")

    rows = found.where("length = 0").select(*[F.col(f"`{c}`") for c in ids], *key, "n_words")
    names = [*[F.col(f"`{c}`") for c in ids], "n_words"]
    clean = [
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,past:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ]
    worded = rows.where("n_words > 0").join(per_text, key, "left").select(*names, *clean)
    none = rows.where("n_words = 0").withColumns({"n_hit": F.lit(None).cast("bigint"), "spans": F.lit(None), "items": F.lit(None)})
    return worded.unionByName(none.select(*names, *clean))
