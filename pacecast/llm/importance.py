"""Target-distribution importance resampling: documents drawn by how much their features look like a target's.

Words come from an untrained regular-expression Split of the tokenizers library over ASCII-lowered text: (word, offsets)
of what no separator covers. Features are runs of one to `longest` consecutive words, joined by one space; a run is the
window between the first word's start and the last one's end in the words joined by one space. A feature's bucket is its
CRC-32 modulo `buckets`. The raw corpus and the target each give one histogram; a bucket's gain is the floored, scaled
logarithm of target share over raw share (one added to each count), a document's weight the sum of its features' gains.
A seeded Gumbel number a document turns weights into scores whose highest are a draw without replacement.

Texts are read once: each document's buckets are written as a small table, which gives first the histogram, then the
weights. The driver holds the histograms alone (`buckets` numbers, a parameter), and gains go to all tasks. Ranks are
counted without one task seeing all rows: rows are ranged by score, numbered within their range, and offset by the
few ranges before.

Null and empty texts have no features and weight 0. A null doc_id counts as empty text in the seeded number; ties go to
the smaller doc_id (nulls last), then to the earlier row, which is fixed by being written. Repeated rows each take part.
An empty table gives no rows; an empty target counts as a histogram of zeros. A long text is split in slices cut at
separators. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacecast.llm.common import map_texts, rows_for, staged, texts_of
from pacecast.llm.simhash import UPPER_TO_LOWER

# Fixed value of the contract: what a word is made of.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST, BUCKETS, SEED = 1, 10_000, "2024"
DRAWN_PERCENT, LEAST_WORDS, SCALE = 10, 20, 1000
SLICE_BYTES = 1 << 18
HELD_WORDS = 200_000
RANK_ROWS = 100_000
SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


class WordBuckets(dict):
    """word -> CRC-32 of its UTF-8 bytes; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        found = self[word] = zlib.crc32(word.encode())
        return found


class Features:
    """Feature buckets of texts. One a Python worker and setting."""

    def __init__(self, longest: int, buckets: int):
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        self.split = Split(Regex(WORD), behavior="removed", invert=True)
        self.longest, self.buckets, self.crc = longest, buckets, WordBuckets()

    def words(self, text: bytes) -> Iterator[str]:
        """Lower-cased words of a UTF-8 text, split slice by slice."""
        low, at = text.translate(UPPER_TO_LOWER), 0
        while at < len(low):
            cut = SEPARATOR.search(low, at + SLICE_BYTES)
            end = cut.start() if cut else len(low)
            for word, _ in self.split.pre_tokenize_str(low[at:end].decode()):
                yield word
            at = end

    def windows(self, words: list[str]) -> Iterator[int]:
        """CRC-32 of each run of two to `longest` words, by offset pairs into the words joined by one space."""
        joined = " ".join(words).encode()
        ends = np.cumsum([len(w.encode()) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        for n in range(2, self.longest + 1):
            for s, e in zip(starts.tolist(), ends[n - 1 :].tolist()):
                yield zlib.crc32(joined[s:e])

    def of(self, text: bytes) -> tuple[int, np.ndarray]:
        """(number of words, buckets of all features, repeats included)."""
        if self.longest == 1:
            crcs = np.fromiter(map(self.crc.__getitem__, self.words(text)), np.int64)
            return len(crcs), (crcs % self.buckets).astype(np.int32)
        words = list(self.words(text))
        crcs = np.fromiter(map(self.crc.__getitem__, words), np.int64, len(words))
        if len(words) > 1:
            crcs = np.concatenate([crcs, np.fromiter(self.windows(words), np.int64)])
        return len(words), (crcs % self.buckets).astype(np.int32)


_features: dict[tuple[int, int], Features] = {}


def features_of(longest: int, buckets: int) -> Features:
    if (longest, buckets) not in _features:
        _features[longest, buckets] = Features(longest, buckets)
    return _features[longest, buckets]


def featured(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words and the buckets of all features of every document, with a row number: a table, read twice."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        maker = features_of(longest, buckets)
        found = [maker.of(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
        ends = np.cumsum([0, *(len(b) for _, b in found)])
        flat = np.concatenate([b for _, b in found]) if found else np.zeros(0, np.int32)
        held = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        counts = pa.array([n for n, _ in found], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, held], names=["doc_id", "n_words", "held"])

    rows = map_texts(texts_of(docs), "doc_id long, n_words long, held array<int>", run)
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "features")


def histogram(held: DataFrame, buckets: int) -> list[int]:
    """Features in each bucket over all documents: summed in tasks, `buckets` rows come to the driver."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("held").flatten().to_numpy(), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    out = [0] * buckets
    counts = held.select("held").mapInArrow(count, "bucket long, n long")
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: list[int], target: list[int], scale: int = SCALE) -> np.ndarray:
    """Each bucket's floored, scaled log ratio of target share and raw share."""
    n, s, t = len(raw), float(sum(raw)), float(sum(target))
    ratios = [((b + 1.0) * (s + n)) / ((a + 1.0) * (t + n)) for a, b in zip(raw, target)]
    return np.array([math.floor(scale * math.log(r)) for r in ratios], np.int64)


def noise(doc_id: int | None, seed: str = SEED, scale: int = SCALE) -> int:
    """The floored, scaled Gumbel number of a document."""
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(key).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(held: DataFrame, gain: np.ndarray, seed: str = SEED, scale: int = SCALE) -> DataFrame:
    """row, doc_id, n_words, n_features, weight, score of every document."""

    def run(batches):
        for batch in batches:
            lists = batch.column("held")
            sizes = pa.compute.list_value_length(lists).to_numpy().astype(np.int64)
            before = np.concatenate([[0], np.cumsum(gain[lists.flatten().to_numpy()])])
            ends = np.cumsum(sizes)
            weight = before[ends] - before[ends - sizes]
            extra = np.array([noise(i, seed, scale) for i in batch.column("doc_id").to_pylist()], np.int64)
            columns = [pa.array(c) for c in (sizes, weight, weight + extra)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("n_words"), *columns],
                names=["row", "doc_id", "n_words", "n_features", "weight", "score"],
            )

    schema = "row long, doc_id long, n_words long, n_features long, weight long, score long"
    return held.mapInArrow(run, schema)


def ranked(rows: DataFrame, drawn: int, rank_rows: int = RANK_ROWS) -> DataFrame:
    """row, rank (from 1) of the `drawn` rows of highest score; ties by doc_id (nulls last), then row.

    The lowest score that is drawn is read off the counts by score; only rows from there on are ranged and numbered.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    parts = rows_for(drawn, rank_rows, least=min(8, 1 + drawn // 1000))
    # The sample that sets the ranges' bounds may differ each time it is drawn, so the ranges are written once.
    tops = staged(
        at_least(rows, drawn).select("row", "doc_id", "score").repartitionByRange(parts, *order)
        .withColumn("part", F.spark_partition_id()), "ranges",
    )
    counts = tops.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    bases = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    placed = tops.withColumn("place", within).join(F.broadcast(bases), "part")  # `parts` rows
    return placed.select("row", (F.col("base") + F.col("place")).cast("long").alias("rank")).where(F.col("rank") <= drawn)


def at_least(rows: DataFrame, drawn: int) -> DataFrame:
    """Rows whose score can be among the `drawn` highest: from the highest bound on that so many rows reach.

    Bounds are steps of the whole range of scores, a fixed number of them, so what is counted does not grow.
    """
    steps = 1024
    low, high = rows.agg(F.min("score"), F.max("score")).first()
    if low is None or drawn <= 0:
        return rows.limit(0)
    width = max(1, -(-(high - low + 1) // steps))
    step = F.floor((F.col("score") - low) / width).cast("long")
    held = {r["step"]: r["n"] for r in rows.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()}
    reached = 0
    for at in sorted(held, reverse=True):
        reached += held[at]
        if reached >= drawn:
            return rows.where(F.col("score") >= low + at * width)
    return rows


def resample(
    docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS, seed: str = SEED, scale: int = SCALE, rank_rows: int = RANK_ROWS,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where a document is not drawn.

    target: text. Of the documents with at least `least_words` words, `percent` per cent (floored) are drawn.
    """
    held = featured(docs, longest, buckets)
    wanted = featured(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), longest, buckets)
    gain = gains(histogram(held, buckets), histogram(wanted, buckets), scale)
    rows = staged(scored(held, gain, seed, scale), "scored")
    able = rows.where(F.col("n_words") >= least_words)
    ranks = ranked(able, percent * able.count() // 100, rank_rows)
    return rows.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
