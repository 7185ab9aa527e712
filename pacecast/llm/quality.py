"""Quality rules: an isolation forest on rule statistics.

Every document gets the counts that common quality rules use; the forest looks at their ratios together. Its trees are
grown on a bounded sample of documents labelled good (SAMPLE rows with the smallest hashes): random features are split
at random values, and a document that few splits set apart is unlike them. As good documents may all agree in a
feature, a split value is drawn from a node's range widened by the feature's deviation over all documents; a side
without sample rows is a leaf. The threshold on the score comes from all labelled rows: the one with the fewest errors,
where rejecting a good document counts GOOD_WEIGHT times.

A document fails the base rules with fewer than 50 words, or with more than half its words in repeated 3-word windows;
such documents, null and empty texts among them, are not kept. Without labels nothing else is rejected. Words are
separated by ASCII white space. Repeated rows get equal results; an empty table gives none.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacecast.llm.common import map_texts, staged, texts_of

LEAST_WORDS, MOST_REPEATED = 50, 0.5
SYMBOLS = b"#*$%&|<>"
SAMPLE, TREES, TREE_ROWS, SEED = 4096, 100, 256, 7
GOOD_WEIGHT = 4
COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_upper n_digits n_stops n_distinct n_lines".split()


def rule_counts(text: bytes) -> tuple[int, ...]:
    """COUNTS of one text in UTF-8."""
    words = text.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS)
    joined = b"".join(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if n > 2:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            times = Counter(windows)
            marked = bytearray(n)
            for i, w in enumerate(windows):
                if times[w] > 1:
                    marked[i : i + 3] = b"\1\1\1"
            repeated = sum(marked)
    shown = joined.decode("utf-8", "replace")
    return (
        n,
        len(shown),
        len(joined) - len(joined.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(joined) - len(joined.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        len(joined) - len(joined.translate(None, b"0123456789")),
        len(joined) - len(joined.translate(None, b".!?,;:")),
        len(set(words)),
        len(lines),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        found = np.array([rule_counts(t or b"") for t in texts], np.int64).reshape(-1, len(COUNTS))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c) for c in found.T]], names=["doc_id", *COUNTS]
        )

    return map_texts(texts_of(docs), "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS), run)


def ratios() -> dict[str, F.Column]:
    """What the forest looks at: ratios, so that length alone is no anomaly."""
    c = {name: F.greatest(F.col(name), F.lit(0)).cast("double") for name in COUNTS}
    words, chars, lines = (F.greatest(c[x], F.lit(1.0)) for x in ("n_words", "word_chars", "n_lines"))
    return {
        "word_length": c["word_chars"] / words,
        "symbols": c["n_symbols"] / words,
        "duplicate_lines": c["n_dup_lines"] / lines,
        "repeated": c["n_repeat_words"] / words,
        "capitals": c["n_upper"] / chars,
        "digits": c["n_digits"] / chars,
        "stops": c["n_stops"] / words,
        "distinct": c["n_distinct"] / F.pow(words, F.lit(0.8)),
    }


class IsolationForest:
    """Random trees over rows that count as normal; score(x) nears 1 for rows that few splits set apart."""

    def __init__(self, rows: np.ndarray, widen: np.ndarray, trees: int = TREES, size: int = TREE_ROWS, seed: int = SEED):
        """rows: the sample by feature; widen: how far beyond a node's range its splits may lie, by feature."""
        rng = np.random.default_rng(seed)
        self.size = max(1, min(size, len(rows)))
        self.height = max(1, int(np.ceil(np.log2(max(self.size, 2)))))
        nodes = 2 ** (self.height + 1)
        self.feature = np.full((trees, nodes), -1, np.int16)
        self.split = np.zeros((trees, nodes))
        self.depth = np.zeros((trees, nodes))  # path length where a path ends
        for t in range(trees):
            chosen = rng.choice(len(rows), self.size, replace=False) if len(rows) else np.zeros(0, np.int64)
            self._grow(t, 1, 0, rows[chosen], widen, rng)

    @staticmethod
    def rest(n: int) -> float:
        """Mean path length of an unsuccessful search among n rows."""
        if n < 2:
            return 0.0
        return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0

    def _grow(self, tree: int, node: int, depth: int, rows: np.ndarray, widen: np.ndarray, rng) -> None:
        usable = np.flatnonzero((np.ptp(rows, axis=0) > 0) | (widen > 0)) if len(rows) else ()
        if depth >= self.height or len(rows) < 2 or not len(usable):
            self.depth[tree, node] = depth + self.rest(len(rows))
            return
        f = int(rng.choice(usable))
        at = rng.uniform(rows[:, f].min() - widen[f], rows[:, f].max() + widen[f])
        self.feature[tree, node], self.split[tree, node] = f, at
        left = rows[:, f] < at
        self._grow(tree, 2 * node, depth + 1, rows[left], widen, rng)
        self._grow(tree, 2 * node + 1, depth + 1, rows[~left], widen, rng)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        row = np.arange(len(x))
        for feature, split, depth in zip(self.feature, self.split, self.depth):
            node = np.ones(len(x), np.int64)
            for _ in range(self.height):
                f = feature[node]
                inner = f >= 0
                right = x[row, np.where(inner, f, 0)] >= split[node]
                node = np.where(inner, 2 * node + right, node)
            total += depth[node]
        return np.exp2(-total / len(self.feature) / max(self.rest(self.size), 1.0))


def fit_forest(counted: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> IsolationForest | None:
    """A forest over labelled good rows that pass the base rules; None where there are none."""
    features = ratios()
    good = labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    passing = counted.where(~base_failed()).join(good, "doc_id", "left_semi")
    chosen = passing.orderBy(F.xxhash64("doc_id"), *COUNTS).limit(sample).select(*features.values()).toPandas()
    if not len(chosen):
        return None
    widen = counted.agg(*[F.coalesce(F.stddev_pop(c), F.lit(0.0)) for c in features.values()]).first()
    return IsolationForest(chosen.to_numpy(np.float64), np.array(widen, np.float64))


def base_failed() -> F.Column:
    words = F.col("n_words")
    return (words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MOST_REPEATED) * words)


def scored(counted: DataFrame, forest: IsolationForest) -> DataFrame:
    """counted with its anomaly score."""
    sent = counted.sparkSession.sparkContext.broadcast(forest)
    names = [*counted.columns, "score"]
    features = {f"_{k}": v for k, v in ratios().items()}
    columns = list(features)

    def run(batches):
        for batch in batches:
            x = np.stack([batch.column(k).to_numpy() for k in columns], axis=1)
            kept = [batch.column(c) for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sent.value.score(x))], names=names)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counted.schema.fields) + ", score double"
    return counted.withColumns(features).mapInArrow(run, schema)


def threshold(table: DataFrame, labels: DataFrame, good_weight: float = GOOD_WEIGHT) -> float:
    """The score from which rejecting makes the fewest weighted errors on all labelled rows that pass the base rules."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = table.where(~base_failed()).join(marks.where(F.col("quality").isin(0, 1)), "doc_id")
    cells = known.groupBy(F.floor(F.col("score") * 1000).alias("cell"), "quality").agg(F.count(F.lit(1)).alias("n"))
    good, bad = np.zeros(1002), np.zeros(1002)
    for r in cells.collect():  # 2,000 rows at most
        (good if r["quality"] == 1 else bad)[r["cell"]] += r["n"]
    errors = good_weight * good[::-1].cumsum()[::-1] + np.r_[0, bad.cumsum()[:-1]]
    best = np.flatnonzero(errors == errors.min())
    return float(best[len(best) // 2]) / 1000


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, score, kept of every row."""
    counted = staged(statistics(docs), "rule-counts")
    forest = fit_forest(counted, labels)
    if forest is None:
        return counted.select("*", base_failed().alias("base_failed"), F.lit(0.0).alias("score"), (~base_failed()).alias("kept"))
    table = staged(scored(counted, forest), "scores")
    limit = threshold(table, labels)
    return table.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") < limit)
    )
