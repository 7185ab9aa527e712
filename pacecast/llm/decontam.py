"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations alone.

A benchmark window (10 consecutive words of an item, or a shorter item whole) occurs in a document where all its words
stand in order. As a set join with full containment its necessary prefix is one token: the window's rarest word, by the
number of times the words of the benchmark occur in all documents. A document word that equals a window's rarest word
gives one candidate place: the word's position less its offset in the window. Length and position bounds (the window
must begin and end inside the document) come first, then the words themselves are compared, so results are exact.

The words of a document are exploded and looked up where they are read; only matches and one count row a document
move. The benchmark's entries are measured and sent to the tasks; beyond BLOCK_BYTES they go in several blocks, each
with a pass of its own over the documents, so no word ever meets its documents in a shuffle. Counting rows go through
partial sums, so a very common word is no hot key.

Null text and null items have no words. Repeated documents keep their number of rows; repeated items each count.
Empty tables: no documents, no rows; no benchmark, nothing is hit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacecast.llm.common import ascii_lower, join_null_safe, rows_for, staged, texts_of

WINDOW = 10
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_BYTES = 32 << 20  # of benchmark data that is sent to every task at once
NO_WINDOW = -1
ENTRY = ""  # no word is empty: the entry that finds each document once and carries its number of words


def words(text: str) -> F.Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAPS), "")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, words: every distinct window of every item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words("text").alias("w"))
    size = F.size("w")
    starts = F.when(size == 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(1), F.greatest(size - window + 1, F.lit(1)))
    )
    each = items.select("item_id", "w", F.explode(starts).alias("at"))
    return each.select("item_id", F.slice("w", F.col("at"), F.lit(window)).alias("words")).distinct()


def in_blocks(small: DataFrame, key: str, size: F.Column, most: int = BLOCK_BYTES) -> list[DataFrame]:
    """The small side in parts that are known to be small enough to send to every task; one part as a rule."""
    held = small.agg(F.sum(size)).first()[0] or 0
    n = rows_for(held, most)
    if n == 1:
        return [F.broadcast(small)]
    return [F.broadcast(small.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)) for i in range(n)]


def word_counts(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """How often each word of the vocabulary occurs in all texts."""
    each = texts.select(F.explode(words("text")).alias("word"))
    blocks = in_blocks(vocabulary, "word", F.octet_length("word") + 64)
    if len(blocks) == 1:
        each = each.join(blocks[0], "word", "left_semi")
    counts = each.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts if len(blocks) == 1 else counts.join(vocabulary, "word", "left_semi")


def window_keys(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """key, offset, words: each distinct window under its rarest word (ties: the smaller word, the earlier place)."""
    distinct = windows.select("words").distinct()
    placed = distinct.select("words", F.posexplode("words").alias("offset", "word"))
    ranked = placed.join(counts, "word", "left").groupBy("words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("rarest")
    )
    return ranked.select(F.col("rarest.word").alias("key"), F.col("rarest.offset").alias("offset"), "words")


def contained_windows(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """doc_id, text_key, at, end, window_id: where each window occurs.

    keys: window_id, key, offset, words; the entry with no words finds each document once, `at` its number of words.
    """
    split = texts.select("doc_id", F.xxhash64("text").alias("text_key"), words("text").alias("w"))
    each = split.select("*", F.posexplode(F.array_append("w", F.lit(ENTRY))).alias("place", "key"))
    at = F.col("place") - F.col("offset")
    fits = (at >= 0) & (at + F.size("words") <= F.size("w"))
    same = F.slice("w", at + 1, F.size("words")) == F.col("words")
    size = F.aggregate("words", F.lit(128), lambda a, w: a + F.octet_length(w) + 8)
    found = []
    for block in in_blocks(keys, "key", size):
        met = each.join(block, "key").where(fits & ((F.col("key") == ENTRY) | same))
        found.append(met.select("doc_id", "text_key", at.alias("at"), (at + F.size("words")).alias("end"), "window_id"))
    return reduce(DataFrame.unionByName, found)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, items (sorted ids as text), copies: one row for each distinct document.

    text_key is the text's 64-bit hash, so rows that share a doc_id but not a text stay apart.
    """
    texts, spark = texts_of(docs), docs.sparkSession
    windows = staged(benchmark_windows(benchmark, window), "windows")
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    keys = window_keys(windows, word_counts(texts, vocabulary))
    numbered = keys.withColumn("window_id", F.monotonically_increasing_id())
    entry = spark.range(1).select(
        F.lit(ENTRY).alias("key"), F.lit(0).alias("offset"), F.array().cast("array<string>").alias("words"),
        F.lit(NO_WINDOW).cast("long").alias("window_id"),
    )
    keys = staged(numbered.unionByName(entry), "window-keys")
    items = staged(windows.join(keys, "words").select("window_id", "item_id"), "window-items")
    return hits_by_document(contained_windows(texts, keys), items)


def hits_by_document(found: DataFrame, items: DataFrame) -> DataFrame:
    """Union of the occurrences' intervals and the distinct items, by document."""
    found = staged(found, "window-places")
    doc = ["doc_id", "text_key"]
    sizes = found.where(F.col("window_id") == NO_WINDOW).groupBy(*doc).agg(
        F.max("at").cast("long").alias("n_words"), F.count(F.lit(1)).alias("copies")
    )
    places = found.where(F.col("window_id") != NO_WINDOW)
    spans = places.groupBy(*doc, "at").agg(F.max("end").alias("end"))
    before = Window.partitionBy(*doc).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    fresh = spans.withColumn("reached", F.greatest(F.coalesce(F.max("end").over(before), F.lit(0)), F.col("at")))
    covered = F.greatest(F.col("end") - F.col("reached"), F.lit(0)).cast("long")
    hit = fresh.groupBy(*doc).agg(F.sum(covered).alias("n_hit"))
    named = places.select(*doc, "window_id").distinct()
    named = reduce(
        DataFrame.unionByName,
        [named.join(b, "window_id").select(*doc, "item_id") for b in in_blocks(items, "item_id", F.octet_length("item_id") + 64)],
    )
    named = named.groupBy(*doc).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    joined = join_null_safe(sizes, join_null_safe(hit, named, doc, "inner"), doc)
    return joined.select(
        *doc,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        "copies",
    )


def per_row(hits: DataFrame) -> DataFrame:
    """As many rows as the documents had."""
    rows = hits.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.drop("_copy", "copies")
