"""Toxicity by class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary labelled texts, share what they back off to: absolute discounting takes
DISCOUNT from every count of a class (all of it, if smaller), and what it took is spread by the counts of both classes
together, which are discounted in turn towards shorter expressions. So an expression that is rare in both classes is
scored alike by both, and only well-attested ones tell them apart. Counts are document counts (an
expression counts once a text, in training and in scoring): a text that repeats a line says it once. The larger
class's counts are scaled to the smaller one's total, so that DISCOUNT means the same in both.

Each place of a text, after its predecessor, has the difference of the two log-likelihoods; what goes beyond the baseline
by more than MARGIN nats is its excess, and a word's excess is the mean over its places. The baseline is the models' own:
the median difference over the words of ordinary training texts, so a text of toxic words alone keeps its evidence. The
sum, normalised by the number of distinct words and by its root, and that of the two most telling words go through a
logistic fit on a fold of labelled rows that the counts have not seen.

All labelled training rows are counted, and nothing is ranked or limited. Words whose scaled counts do not exceed the
discount in either class keep nothing of their own; they are one shared rare word, which is no evidence, and no pair
with one can exceed the discount. Tasks get every word and pair whose excess is not nought, and every pair that takes away its word's excess: the
others change no score.

Null and empty texts have no expressions and get the score of no evidence. Labels that are null are left out; a
document without label, or labels of one class alone, leave a model that knows nothing (every score is the prior).
Repeated rows and labels count as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacecast.llm.common import map_texts, small_batches, staged, texts_of

WORD = re.compile(r"[^\W\d_]+")
SENT_LABELS = 1_000_000  # up to so many labels go to every task (about 16 MB); beyond, texts and labels are shuffled
SENT_WORDS = 1_000_000  # joins send the words of pairs up to so many; beyond, they shuffle
DISCOUNT, PAIR_DISCOUNT, SHARED_DISCOUNT, MARGIN = 3.0, 3.0, 0.75, 1.5
RARE = ""
CALIBRATION_FOLDS = 5  # one of these many folds of the training rows calibrates
PENALTY = 0.1
HELD_COUNTS = 250_000  # a task sums up to so many expressions before they move (about 25 MB)


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def training_rows(docs: DataFrame, labels: DataFrame, trainable: Column) -> DataFrame:
    """text, toxic, calibrates: labelled texts that may be learnt from. Only rows that pass `trainable` move."""
    texts = texts_of(docs.where(trainable)).where("doc_id is not null")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION_FOLDS)) == 0
    if marks.count() <= SENT_LABELS:
        marks = F.broadcast(marks)
    return texts.join(marks, "doc_id").select("text", "toxic", fold.alias("calibrates"))


def _counted(rows: DataFrame, key: str, expressions) -> DataFrame:
    """key, toxic, n: in how many texts of each class an expression occurs; summed in each task before it moves."""

    def run(batches):
        held: tuple[dict, dict] = ({}, {})

        def flush():
            for toxic, counts in enumerate(held):
                if counts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(counts)), pa.array([toxic] * len(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())],
                        names=[key, "toxic", "n"],
                    )
                    counts.clear()

        for batch in small_batches(batches):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts = held[toxic]
                for x in expressions(text or ""):
                    counts[x] = counts.get(x, 0) + 1
            if len(held[0]) + len(held[1]) > HELD_COUNTS:
                yield from flush()
        yield from flush()

    parts = rows.mapInArrow(run, f"{key} string, toxic int, n long")
    of = lambda toxic: F.sum(F.when(F.col("toxic") == toxic, F.col("n")).otherwise(0)).cast("double")
    return parts.groupBy(key).agg(of(0).alias("ordinary"), of(1).alias("toxic"))


class KneserNey:
    """log p(w | h, toxic) - log p(w | h, ordinary) from two classes' document counts."""

    def __init__(self, unigrams: dict, rest: np.ndarray, pairs: dict, contexts: dict, discount: float = DISCOUNT, pair_discount: float = PAIR_DISCOUNT):
        """unigrams: word -> (ordinary, toxic) counts; rest: the counts of all others together.
        pairs: 'h w' -> counts of pairs; contexts: h -> (all counts by class, mass taken from its pairs by class, (its
        count in both, its kinds of pairs)); class counts scaled."""
        counts = np.array([*unigrams.values(), rest], np.float64).reshape(-1, 2)
        scaled = counts * self.scale_of(counts.sum(0))
        self._settle(counts.sum(0), np.minimum(scaled, discount).sum(0), np.array(rest, np.float64), discount, pair_discount)
        self.unigram = self.shares(counts)
        ratios = self.word_ratios(counts)
        self.ratio = dict(zip(unigrams, ratios.tolist()))
        self.baseline = self.middle(ratios, counts[:, 0])
        found = {}
        for pair, seen in pairs.items():
            h, w = pair.split(" ")
            of = [np.array([x], np.float64) for x in (seen, *contexts[h], unigrams.get(w, rest))]
            found[h, w] = float(self.pair_ratios(*of)[0])
        self.ship(self.ratio, found)

    @classmethod
    def of_sums(cls, totals: np.ndarray, taken: np.ndarray, rest: np.ndarray) -> KneserNey:
        """The models of words that stay in a table: all counts by class, the mass taken from all, the rare words' counts."""
        self = cls.__new__(cls)
        self._settle(totals, taken, rest, DISCOUNT, PAIR_DISCOUNT)
        return self

    @staticmethod
    def scale_of(totals: np.ndarray) -> np.ndarray:
        return np.minimum(1.0, totals[::-1] / np.maximum(totals, 1e-9))

    def _settle(self, totals, taken, rest, discount: float, pair_discount: float) -> None:
        self.scale, self.known = self.scale_of(totals), bool((totals > 0).all())
        self.all, self.mass = max(totals.sum(), 1e-9), np.maximum(totals * self.scale, 1e-9)
        self.taken, self.discount, self.pair_discount = taken, discount, pair_discount
        self.rare_ratio = float(self.word_ratios(rest.reshape(1, 2))[0])
        self.baseline, self.words, self.pairs = 0.0, {}, {}

    def shares(self, counts: np.ndarray) -> np.ndarray:
        """p(w | class) of words with these counts."""
        pooled = np.maximum(counts.sum(1) / self.all, 1e-12)
        return np.maximum(counts * self.scale - self.discount, 0) / self.mass + self.taken / self.mass * pooled[:, None]

    def word_ratios(self, counts: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.zeros(len(counts))
        p = self.shares(counts)
        return np.log(p[:, 1] / p[:, 0])

    def pair_ratios(self, seen, total, kept, both, own) -> np.ndarray:
        """Ratios of pairs: their counts, their head's totals, the mass taken and (count, kinds), their word's counts."""
        if not self.known:
            return np.zeros(len(seen))
        pooled = own.sum(1) / self.all
        shared = np.maximum(seen.sum(1) - SHARED_DISCOUNT, 0) + SHARED_DISCOUNT * both[:, 1] * pooled
        left = np.maximum(seen * self.scale - self.pair_discount, 0)
        p = (left + kept * (shared / both[:, 0])[:, None]) / np.maximum(total, 1e-9)
        whole = (p > 0).all(1)
        p = np.where(whole[:, None], p, 1.0)
        return np.where(whole, np.log(p[:, 1] / p[:, 0]), self.word_ratios(own))

    @staticmethod
    def middle(ratios: np.ndarray, weights: np.ndarray) -> float:
        """The weighted median."""
        order = np.argsort(ratios, kind="stable")
        reached = np.cumsum(weights[order])
        return float(ratios[order][np.searchsorted(reached, reached[-1] / 2)]) if len(reached) and reached[-1] > 0 else 0.0

    def excess(self, ratios, margin: float = MARGIN):
        return np.maximum(ratios - self.baseline - margin, 0.0)

    def ship(self, words: dict, pairs: dict) -> None:
        """Keep what changes a score: ratios by word, and by (predecessor, word)."""
        over = lambda ratios: {k: x for k, r in ratios.items() if (x := float(self.excess(r))) > 0}
        self.words = over(words) if self.known else {}
        self.pairs = {k: float(self.excess(r)) for k, r in pairs.items() if k[1] in self.words or self.excess(r) > 0}

    def excesses(self, ws: list[str]) -> tuple[list[float], int]:
        """The excess of each telling word (the mean over its places), and the number of distinct words."""
        own, pairs = self.words, self.pairs
        out = {w: own[w] for w in ws if w in own}
        changes: dict[str, float] = {}
        for pair in zip(ws, ws[1:]):
            found = pairs.get(pair)
            if found is not None:
                changes[pair[1]] = changes.get(pair[1], 0.0) + found - own.get(pair[1], 0.0)
        if changes:
            times = Counter(ws)
            for w, change in changes.items():
                out[w] = out.get(w, 0.0) + change / times[w]
        return list(out.values()), len(set(ws))

    def evidence(self, text: str) -> tuple[float, float, float]:
        """The toxic excess over the baseline: by distinct word, by root of their number, of the two most telling."""
        found, n = self.excesses(words(text))
        if not found:
            return 0.0, 0.0, 0.0
        total = sum(found)
        return total / n, min(total / n**0.5, 20.0), sum(sorted(found)[-2:]) / 2


class ToxicityModel:
    """What a task needs to score texts: the two models and the logistic fit."""

    def __init__(self, models: KneserNey, fit):
        self.models, self.fit = models, fit

    def score(self, evidence: np.ndarray) -> np.ndarray:
        weights, mean, deviation = self.fit
        z = np.c_[(evidence - mean) / deviation, np.ones(len(evidence))] @ weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Attested:
    """A set of words as sorted 64-bit keys, 8 bytes each."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.met = np.sort(keys), {}

    @staticmethod
    def key(word: str) -> int:
        return int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little", signed=True)

    def __contains__(self, word: str) -> bool:
        found = self.met.get(word)
        if found is None:
            if len(self.met) > 50_000:
                self.met.clear()
            key = self.key(word)
            at = np.searchsorted(self.keys, key)
            found = self.met[word] = bool(at < len(self.keys) and self.keys[at] == key)
        return found


def _columns(batch: pa.RecordBatch, *names: str) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], 1).astype(np.float64)


def _with(rows: DataFrame, schema: str, **values) -> DataFrame:
    """rows and more columns, as the schema types them, each by a function of the batch."""

    def run(batches):
        for batch in batches:
            more = [pa.array(f(batch)) for f in values.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *values])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{types}, {schema}")


def _word_models(counted: DataFrame) -> tuple[KneserNey, DataFrame]:
    """The models without pairs, and the attested words: word, ordinary, toxic, ratio, key."""
    spark, classes = counted.sparkSession, ("ordinary", "toxic")
    totals = np.array(counted.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in classes]).first(), np.float64)
    scaled = [F.col(c) * float(x) for c, x in zip(classes, KneserNey.scale_of(totals))]
    attested = counted.where(F.greatest(*scaled) > DISCOUNT)
    of = [F.coalesce(F.sum(x), F.lit(0.0)) for x in (*map(F.col, classes), *[F.least(x, F.lit(DISCOUNT)) for x in scaled])]
    sums = np.array(attested.agg(*of).first(), np.float64)
    rest = np.maximum(totals - sums[:2], 0)
    models = KneserNey.of_sums(totals, sums[2:] + np.minimum(rest * KneserNey.scale_of(totals), DISCOUNT), rest)
    sent = spark.sparkContext.broadcast(models)
    attested = _with(
        attested, "ratio double, key long",
        ratio=lambda batch: sent.value.word_ratios(_columns(batch, *classes)),
        key=lambda batch: np.array([Attested.key(w) for w in batch.column("word").to_pylist()], np.int64),
    )
    attested = staged(attested, "attested-words")
    grid = attested.groupBy(F.round("ratio", 3).alias("ratio")).agg(F.sum("ordinary").alias("n")).toArrow().to_pydict()
    ratios, n = (np.array([*grid[c], x], np.float64) for c, x in (("ratio", models.rare_ratio), ("n", rest[0])))
    models.baseline = models.middle(ratios, n)
    return models, attested


def _pair_ratios(counting: DataFrame, models: KneserNey, attested: DataFrame) -> DataFrame:
    """h, w, ratio of all pairs that exceed the discount in a class and can change a score."""
    spark, classes = counting.sparkSession, ("ordinary", "toxic")
    keys = attested.select("key").toArrow().column("key").to_numpy()
    sent, shipped = spark.sparkContext.broadcast(Attested(keys)), spark.sparkContext.broadcast(models)

    def pairs_in(text: str) -> set[str]:
        known = sent.value
        ws = [w if w in known else RARE for w in words(text)]
        return {f"{a} {b}" for a, b in zip(ws, ws[1:]) if a}

    paired = staged(_counted(counting, "pair", pairs_in), "pair-counts")
    paired = paired.select(
        F.substring_index("pair", " ", 1).alias("h"), F.substring_index("pair", " ", -1).alias("w"), *classes
    )
    scaled = {c: F.col(c) * float(x) for c, x in zip(classes, models.scale)}
    own = paired.where((F.col("w") != RARE) & (F.greatest(*scaled.values()) > PAIR_DISCOUNT))
    ends = {c: staged(own.select(c).distinct(), f"pair-{c}") for c in "hw"}
    few = {c: ends[c].count() <= SENT_WORDS for c in "hw"}
    small = lambda df, c: F.broadcast(df) if few[c] else df
    heads = paired.join(small(ends["h"], "h"), "h", "left_semi").groupBy("h").agg(
        *[F.sum(x).alias(f"all_{c}") for c, x in scaled.items()],
        *[F.sum(F.least(x, F.lit(PAIR_DISCOUNT))).alias(f"kept_{c}") for c, x in scaled.items()],
        F.sum(F.col("ordinary") + F.col("toxic")).alias("both"),
        F.count(F.lit(1)).cast("double").alias("kinds"),
    )
    seconds = attested.select(F.col("word").alias("w"), *[F.col(c).alias(f"own_{c}") for c in classes], F.col("ratio").alias("own"))
    seconds = seconds.join(small(ends["w"], "w"), "w", "left_semi")
    rows = own.join(small(heads, "h"), "h").join(small(seconds, "w"), "w")
    by_class = lambda batch, kind: _columns(batch, *[f"{kind}{c}" for c in classes])
    found = _with(
        rows, "ratio double",
        ratio=lambda b: shipped.value.pair_ratios(
            by_class(b, ""), by_class(b, "all_"), by_class(b, "kept_"), _columns(b, "both", "kinds"), by_class(b, "own_")
        ),
    )
    return found.where(F.greatest("ratio", "own") > models.baseline + MARGIN).select("h", "w", "ratio")


def train(docs: DataFrame, labels: DataFrame, trainable: Column) -> ToxicityModel:
    """Count, smooth and calibrate. Counting is distributed; the driver gets what tells, and the fold's evidence."""
    rows = staged(training_rows(docs, labels, trainable), "labelled-texts")
    counting, spark = rows.where("not calibrates"), docs.sparkSession
    counted = staged(_counted(counting, "word", lambda t: set(words(t))), "word-counts")
    models, attested = _word_models(counted)
    if models.known:
        single = attested.where(F.col("ratio") > models.baseline + MARGIN).select("word", "ratio").toArrow().to_pydict()
        double = _pair_ratios(counting, models, attested).toArrow().to_pydict()
        models.ship(dict(zip(single["word"], single["ratio"])), dict(zip(zip(double["h"], double["w"]), double["ratio"])))
    shipped = spark.sparkContext.broadcast(models)

    def weigh(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shipped.value.evidence(t or "") for t in batch.column("text").to_pylist()]
        columns = [pa.array(c) for c in zip(*found)]
        return pa.RecordBatch.from_arrays([*columns, batch.column("toxic")], names=["a", "b", "c", "toxic"])

    held = map_texts(rows.where("calibrates").select("text", "toxic"), "a double, b double, c double, toxic int", weigh)
    # Evidence is rounded and counted, so the fit sees every row of the fold through a table that its grid bounds.
    grid = [F.round(c, digits).alias(c) for c, digits in (("a", 2), ("b", 1), ("c", 1))]
    cells = held.groupBy(*grid, "toxic").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pydict()
    x = np.array([cells["a"], cells["b"], cells["c"]], np.float64).T.reshape(-1, 3)
    return ToxicityModel(models, fit_weighted(x, np.array(cells["toxic"], np.float64), np.array(cells["n"], np.float64)))


def fit_weighted(x: np.ndarray, y: np.ndarray, n: np.ndarray, penalty: float = PENALTY):
    """(weights with the constant last, means, deviations): a penalised logistic fit by Newton steps, of rows that stand
    for n rows each. The penalty keeps it finite when only one class, or no row, is there."""
    total = max(n.sum(), 1.0)
    mean = (x * n[:, None]).sum(0) / total if len(x) else np.zeros(x.shape[1])
    deviation = np.sqrt(((x - mean) ** 2 * n[:, None]).sum(0) / total) + 1e-9 if len(x) else np.ones(x.shape[1])
    a = np.c_[(x - mean) / deviation, np.ones(len(x))]
    weights, ridge = np.zeros(a.shape[1]), np.full(a.shape[1], penalty)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ weights, -30, 30)))
        hessian = (a * (n * p * (1 - p))[:, None]).T @ a + np.diag(ridge)
        step = np.linalg.solve(hessian, a.T @ (n * (p - y)) + ridge * weights)
        weights -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return weights, mean, deviation


def score_texts(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = sent.value
        evidence = np.array([m.models.evidence(t or "") for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(m.score(evidence))], names=["doc_id", "score"])

    return map_texts(texts_of(docs), "doc_id long, score double", run)


def kept_rows(docs: DataFrame, model: ToxicityModel, limit: float) -> DataFrame:
    """The rows, with all their columns, whose text scores below `limit`."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in small_batches(batches):
            evidence = np.array([sent.value.models.evidence(t or "") for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array(sent.value.score(evidence) < limit))

    return docs.mapInArrow(run, docs.schema)
