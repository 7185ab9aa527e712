"""Exact token counts: a histogram of encoded lengths and its suffix sums answer every context limit.

Each task encodes its documents and hands on (group, length, count) rows alone; their sum over all tasks is exact and
has no more rows than there are lengths. Sums from the longest length down then give, at every length, how many
documents are longer and how many tokens those hold; from these follow totals, quantiles and truncated totals.
Suffix sums run within blocks of lengths and over the few blocks, so no group of lengths is summed in one task.

Null and empty texts have length 0 (plus `extra` end ids). A null group is a group. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacecast.llm.common import join_null_safe, small_batches
from pacecast.llm.wordcache import word_cache

BLOCK = 1024


def histogram(docs: DataFrame, tokenizer: str, group: str = "lang", extra: int = 0) -> DataFrame:
    """group, length, n over all documents."""
    rows = docs.select(F.col(group).cast("string").alias("group"), F.col("text").cast("string").alias("text"))

    def run(batches):
        held: dict[tuple, int] = {}
        for batch in small_batches(batches):
            cache = word_cache(tokenizer)
            packed = cache.encode([t or "" for t in batch.column("text").to_pylist()])
            for g, ids in zip(batch.column("group").to_pylist(), packed):
                key = g, len(ids) // cache.dtype.itemsize + extra
                held[key] = held.get(key, 0) + 1
        groups, lengths = zip(*held) if held else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(groups, pa.string()), pa.array(lengths, pa.int64()), pa.array(np.array([*held.values()], np.int64))],
            names=["group", "length", "n"],
        )

    parts = rows.mapInArrow(run, "`group` string, length long, n long")
    return parts.groupBy("group", "length").agg(F.sum("n").alias("n"))


def limits(counts: DataFrame) -> DataFrame:
    """One row for each length that occurs, taken as a context limit: group, length, n, n_longer, tokens_longer,
    n_docs and total_tokens of the group, truncated_total (tokens left if all texts are cut at it), share (of
    documents that are no longer: the length is the quantile of every q up to it and above the row before)."""
    cells = counts.withColumn("tokens", F.col("n") * F.col("length")).withColumn(
        "block", F.floor(F.col("length") / BLOCK)
    )
    blocks = cells.groupBy("group", "block").agg(F.sum("n").alias("_n"), F.sum("tokens").alias("_tokens"))
    above = Window.partitionBy("group").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("group")
    later = blocks.select(
        "group",
        "block",
        *[F.coalesce(F.sum(f"_{c}").over(above), F.lit(0)).alias(f"later_{c}") for c in ("n", "tokens")],
        F.sum("_n").over(whole).alias("n_docs"),
        F.sum("_tokens").over(whole).alias("total_tokens"),
    )
    inside = Window.partitionBy("group", "block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    own = [F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"own_{c}") for c in ("n", "tokens")]
    joined = join_null_safe(cells.select("group", "block", "length", "n", *own), later, ["group", "block"])
    n_longer, tokens_longer = F.col("own_n") + F.col("later_n"), F.col("own_tokens") + F.col("later_tokens")
    return joined.select(
        "group",
        "length",
        "n",
        n_longer.alias("n_longer"),
        tokens_longer.alias("tokens_longer"),
        "n_docs",
        "total_tokens",
        (F.col("total_tokens") - tokens_longer + F.col("length") * n_longer).alias("truncated_total"),
        ((F.col("n_docs") - n_longer) / F.col("n_docs")).alias("share"),
    )


def quantile(table: DataFrame, q: float) -> DataFrame:
    """group, length: the smallest length that at least a share q of the group's documents do not pass."""
    return table.where(F.col("share") >= q).groupBy("group").agg(F.min("length").alias("length"))


def truncated_total(table: DataFrame, limit: int) -> DataFrame:
    """group, truncated_total at any limit, also between the lengths that occur."""
    longer = F.col("length") > limit
    total = F.sum(F.when(longer, limit * F.col("n")).otherwise(F.col("length") * F.col("n")))
    return table.groupBy("group").agg(total.alias("truncated_total"))
