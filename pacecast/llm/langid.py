"""Language ID by prediction by partial matching.

For each language a context tree of up to ORDER bytes is counted from its labelled texts: how often each byte follows
each context. Frozen, it gives exact code lengths: in the longest known context a byte costs its share, method C
(escape counts are the numbers of different followers); a byte not seen there costs the escape, and the next shorter
context is asked with the followers already excluded; below the empty context all other bytes are equally likely. The
language whose code for a text is shortest is predicted; the score is its posterior under equal priors.

Counting is a distributed sum over all rows that may be learnt from, in tables of (language, last bytes, count). The
longest contexts' followers that a language shows fewer than LEAST times are pruned from its frozen tree, in all languages
alike; shorter contexts keep all their followers, so every language with any text has a tree, and no language's tree
depends on how much text the others have. A position's cost depends on its last ORDER + 1 bytes
alone, so tasks work out each distinct run of bytes once a batch, in numpy.

Texts are lower-cased first, with ORDER zero bytes before them. Null texts, and texts without a letter, are `und` with
score 0. Rows without a language teach nothing. If no row teaches, every text is `und`. Languages that tie go to the
first in order of name. Very long texts are read in windows; repeated rows count as often as they occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacecast.llm.common import map_texts, small_batches, staged, texts_of

ORDER = 3  # bytes of context; with the predicted byte a run fits 32 bits
LEAST = 2
WINDOW = 1 << 20
UNKNOWN = "und"


def runs_of(text: bytes) -> np.ndarray:
    """Each position's last ORDER + 1 bytes as one number, the predicted byte lowest."""
    b = np.frombuffer(bytes(ORDER) + text, np.uint8).astype(np.uint32)
    n = len(text)
    out = b[ORDER : ORDER + n].copy()
    for back in range(1, ORDER + 1):
        out |= b[ORDER - back : ORDER - back + n] << np.uint32(8 * back)
    return out


def count_runs(docs: DataFrame, trainable: Column) -> DataFrame:
    """lang, run, n over all rows that may be learnt from; summed in each task before it moves."""
    rows = docs.where(trainable).where("lang is not null and text is not null")
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.lower("text").alias("text"))

    def run(batches):
        held: dict[str, list] = {}

        def summed(parts):
            keys = np.concatenate([k for k, _ in parts])
            found, inverse = np.unique(keys, return_inverse=True)
            return found, np.bincount(inverse, np.concatenate([c for _, c in parts])).astype(np.int64)

        for batch in small_batches(batches):
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                runs = np.sort(runs_of(bytes(ORDER).join(own)))
                starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]]) if len(runs) else np.zeros(0, np.int64)
                parts = held.setdefault(lang, [])
                parts.append((runs[starts], np.diff(np.r_[starts, len(runs)])))
                if len(parts) > 16:
                    held[lang] = [summed(parts)]
        for lang, parts in held.items():
            found, n = summed(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found)), pa.array(found.astype(np.int64)), pa.array(n)], names=["lang", "run", "n"]
            )

    counts = rows.mapInArrow(run, "lang string, run long, n long")
    return counts.groupBy("lang", "run").agg(F.sum("n").alias("n"))


class ContextTrees:
    """The frozen trees of all languages; costs(runs) gives the code length of each run's last byte by language."""

    def __init__(
        self,
        languages: list[str],
        counts: list[tuple[np.ndarray, np.ndarray]],
        shorter: list[tuple[np.ndarray, np.ndarray]] | None = None,
    ):
        """counts: for each language its distinct runs (ORDER + 1 bytes) and how often each occurs; shorter: the same for
        runs of ORDER bytes, which all shorter contexts are read from (if left out, they are read from `counts` too)."""
        self.languages = languages
        self.levels = []  # from the longest context down to the empty one
        plain = lambda tables: [(r.astype(np.uint64), n.astype(np.float64)) for r, n in tables]
        longest, rest = plain(counts), plain(counts if shorter is None else shorter)
        for order in range(ORDER, -1, -1):
            keep = np.uint64((1 << 8 * (order + 1)) - 1)
            tables = []
            for runs, n in longest if order == ORDER else rest:
                short, inverse = np.unique(runs & keep, return_inverse=True)
                tables.append((short, np.bincount(inverse, n, len(short))))
            self.levels.append(self._level(tables))
        for depth, (above, level) in enumerate(zip(self.levels, self.levels[1:])):
            level["excluded"] = self._excluded(above, level, ORDER - depth)

    @staticmethod
    def _level(tables) -> dict:
        """Followers and contexts of one order, languages side by side (0: not in that language's tree)."""
        runs = np.unique(np.concatenate([r for r, _ in tables])) if tables else np.zeros(0, np.uint64)
        n = np.zeros((len(runs), len(tables)))
        for j, (r, c) in enumerate(tables):
            n[np.searchsorted(runs, r), j] = c
        contexts, starts = np.unique(runs >> np.uint64(8), return_index=True)
        total = np.add.reduceat(n, starts, axis=0) if len(starts) else np.zeros((0, len(tables)))
        kinds = np.add.reduceat(n > 0, starts, axis=0, dtype=np.float64) if len(starts) else np.zeros((0, len(tables)))
        return {"runs": runs, "n": n, "contexts": contexts, "total": total, "kinds": kinds}

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def _excluded(self, above: dict, level: dict, order: int) -> tuple[np.ndarray, np.ndarray]:
        """For each longer context: what its followers make up in the next shorter one (count, kinds)."""
        keep = np.uint64((1 << 8 * order) - 1)  # the shorter context and the byte
        at, found = self._find(level["runs"], above["runs"] & keep)
        inside = above["n"] > 0
        n = np.where(inside & found[:, None], level["n"][at], 0.0)
        starts = np.unique(above["runs"] >> np.uint64(8), return_index=True)[1]
        if not len(starts):
            return n, n
        return np.add.reduceat(n, starts, axis=0), np.add.reduceat(inside, starts, axis=0, dtype=np.float64)

    def costs(self, runs: np.ndarray) -> np.ndarray:
        """Bits of each run's last byte, by language."""
        runs = runs.astype(np.uint64)
        m, k = len(runs), len(self.languages)
        bits, done, entered = np.zeros((m, k)), np.zeros((m, k), bool), np.zeros((m, k), bool)
        gone_n, gone_kinds = np.zeros((m, k)), np.zeros((m, k))  # excluded on entry to the level
        for depth, level in enumerate(self.levels):
            order = ORDER - depth
            key = runs & np.uint64((1 << 8 * (order + 1)) - 1)
            c_at, c_found = self._find(level["contexts"], key >> np.uint64(8))
            r_at, r_found = self._find(level["runs"], key)
            there = c_found[:, None] & (level["total"][c_at] > 0) if len(level["contexts"]) else np.zeros((m, k), bool)
            n = np.where(r_found[:, None], level["n"][r_at], 0.0) if len(level["runs"]) else np.zeros((m, k))
            total = np.where(there, level["total"][c_at], 0.0) - gone_n if len(level["contexts"]) else -gone_n
            kinds = np.where(there, level["kinds"][c_at], 0.0) - gone_kinds if len(level["contexts"]) else -gone_kinds
            asked = there & ~done & (kinds > 0)
            hit = asked & (n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                bits += np.where(hit, np.log2(total + kinds) - np.log2(n), 0.0)
                bits += np.where(asked & ~hit, np.log2(total + kinds) - np.log2(kinds), 0.0)
            done |= hit
            entered |= there
            if depth + 1 < len(self.levels):
                below_n, below_kinds = self.levels[depth + 1]["excluded"]
                if len(below_n):
                    gone_n = np.where(there, below_n[c_at], 0.0)
                    gone_kinds = np.where(there, below_kinds[c_at], 0.0)
        seen = self.levels[-1]["kinds"][0] if len(self.levels[-1]["kinds"]) else np.zeros(k)
        return bits + np.where(done, 0.0, np.log2(np.maximum(256 - seen, 1)))

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text by language."""
        out = np.zeros((len(texts), len(self.languages)))
        lengths = np.array([len(t) for t in texts])
        runs = runs_of(bytes(ORDER).join(texts)) if len(texts) else np.zeros(0, np.uint32)
        starts = np.cumsum(lengths + ORDER) - (lengths + ORDER)
        owner = np.repeat(np.arange(len(texts)), lengths)
        places = np.arange(len(owner)) + ORDER * owner
        for at in range(0, len(places), WINDOW):
            part, own = places[at : at + WINDOW], owner[at : at + WINDOW]
            found, inverse = np.unique(runs[part], return_inverse=True)
            cost = self.costs(found)
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            for j in range(len(self.languages)):
                out[own[first], j] += np.add.reduceat(cost[:, j][inverse], first)
        return out

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the best language, posterior, bits by byte)."""
        bits = self.code_lengths(texts)
        best = bits.argmin(1)
        least = bits[np.arange(len(bits)), best]
        posterior = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
        return best, posterior, least / np.maximum([len(t) for t in texts], 1)


def train(docs: DataFrame, trainable: Column) -> ContextTrees:
    """Count over all trainable rows, prune each language's longest contexts, freeze; the driver holds what is kept."""
    counts = staged(count_runs(docs, trainable), "byte-runs")
    languages = [r["lang"] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    place = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1 if languages else F.lit(0)

    def by_language(rows: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
        found = rows.select(place.cast("short").alias("at"), "run", "n").toArrow()
        at, runs, n = (found.column(c).to_numpy() for c in ("at", "run", "n"))
        return [(runs[own], n[own]) for own in (at == j for j in range(len(languages)))]

    short = F.col("run").bitwiseAND(F.lit((1 << 8 * ORDER) - 1))
    shorter = counts.groupBy("lang", short.alias("run")).agg(F.sum("n").alias("n"))
    return ContextTrees(languages, by_language(counts.where(F.col("n") >= LEAST)), by_language(shorter))


def predict(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """doc_id, lang_pred, score, bits_per_byte of every row, from its text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(trees)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = texts_of(docs).select("doc_id", F.when(letters, F.lower("text")).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        known = [i for i, t in enumerate(texts) if t is not None and sent.value.languages]
        lang, score, bits = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        if known:
            best, score[known], bits[known] = sent.value.predict([texts[i] for i in known])
            for i, j in zip(known, best):
                lang[i] = sent.value.languages[j]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lang), pa.array(score), pa.array(bits)],
            names=["doc_id", "lang_pred", "score", "bits_per_byte"],
        )

    return map_texts(rows, "doc_id long, lang_pred string, score double, bits_per_byte double", run, most=1 << 20)
