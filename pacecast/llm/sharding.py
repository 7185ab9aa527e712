"""Proportional stratified interleaving: every shard gets each source in the share it has of the whole.

Rows of a source are ordered by a seeded hash; the row of rank r among n gets the fraction (r + u) / n, where u in
[0, 1) is a seeded hash of its source. All rows sorted by that fraction are an even mixture at every point, so cutting
them into equal runs gives shards whose row counts differ by one at most (law `rows`) and whose sources match the
whole. Every source and null source is a stratum; u keeps sources of few rows from meeting at one fraction.

Ranks are counted in two steps, so that no source, however hot, meets in one task: rows are counted by (source, slice
of the hash), the few counts are summed up, and rows are numbered within a slice. Fractions are even by construction,
so the same is done by slices of the fraction for the place among all rows. Wholly equal rows are one row with a
number of copies until their ranks are known, and spread over the fractions of these ranks.

Null or repeated doc_ids are rows like others (the hash covers size and checksum too, ties are broken by them); null
text has size 1. Texts of any length are read once, for size and checksum alone. An empty table gives no rows. Other
columns of the documents are not read. Law `rows` and groups of equal texts exclude each other, so groups are not kept
together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacecast.llm.common import join_null_safe, rows_for, staged, texts_of

SEED = "interleave-1"
SLICE_ROWS = 5_000
COPY_BLOCK = 10_000  # copies of a row are written out in blocks of so many, so that no array grows with them
ROW = ["doc_id", "source", "size", "text_crc32"]


def _numbered(df: DataFrame, group: list[str], cut: str, order: list, name: str) -> DataFrame:
    """Add `name`: the rows before this one in its group by (cut, order), copies counted; `cut` slices the group evenly."""
    counts = df.groupBy(*group, cut).agg(F.sum("_copies").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*group, cut, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*group, cut).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = join_null_safe(df, bases, [*group, cut])
    before = F.coalesce(F.sum("_copies").over(within), F.lit(0))
    return joined.withColumn(name, F.col("_base") + before).drop("_base")


def distinct_rows(docs: DataFrame) -> DataFrame:
    """What placing needs of each row, wholly equal rows as one with `_copies`."""
    rows = texts_of(docs, F.col("source").cast("string").alias("source")).select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return rows.groupBy(*ROW).agg(F.count(F.lit(1)).alias("_copies"))


def sliced(rows: DataFrame, slices: int, seed: str) -> DataFrame:
    """Add `_key`, the seeded hash of all that tells a row of a source from others, and `_slice`, its share of the key's range."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "size", "text_crc32")]
    share = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * slices / F.lit(1 << 32)
    return rows.withColumn("_key", F.md5(F.concat_ws(":", F.lit(seed), *told))).withColumn("_slice", share.cast("int"))


def mixed(ranked: DataFrame, slices: int, seed: str) -> DataFrame:
    """One row a copy again, with its fraction and `_cut`, the slice of the fractions it falls into."""
    sizes = ranked.groupBy("source").agg(F.sum("_copies").alias("_of"))
    rows = join_null_safe(ranked, sizes, ["source"])
    last = F.col("_copies") - 1
    rows = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPY_BLOCK))))
    first = F.col("_block") * COPY_BLOCK
    rows = rows.withColumn("_copy", F.explode(F.sequence(first, F.least(first + COPY_BLOCK - 1, last))))
    rows = rows.withColumn("_rank", F.col("_rank") + F.col("_copy")).withColumn("_copies", F.lit(1).cast("long"))
    u = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 32)) / F.lit(1 << 32)
    rows = rows.withColumn("fraction", (F.col("_rank") + u) / F.col("_of"))
    return rows.withColumn("_all", F.lit(0)).withColumn("_cut", (F.col("fraction") * slices).cast("int"))


def interleave(docs: DataFrame, shards: int = 8, seed: str = SEED, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, source, size, text_crc32, fraction, shard, slot: all rows, shards cut from the even mixture."""
    rows = staged(distinct_rows(docs), "rows")
    total = rows.agg(F.sum("_copies")).first()[0] or 0
    slices = rows_for(total, slice_rows)
    ranked = _numbered(sliced(rows, slices, seed), ["source"], "_slice", ["_key", *ROW], "_rank")
    order = ["fraction", F.col("source").asc_nulls_first(), "_rank"]
    placed = _numbered(mixed(ranked, slices, seed), ["_all"], "_cut", order, "_place")
    shard = F.floor(F.col("_place") * shards / F.lit(max(total, 1))).cast("int")
    first = F.ceil(F.col("shard") * F.lit(total) / shards).cast("long")
    placed = placed.withColumn("shard", shard).withColumn("slot", F.col("_place") - first)
    return placed.select(*ROW, "fraction", "shard", "slot")


def write_shards(docs: DataFrame, path: str, **settings) -> None:
    """Write doc_id, source, size and slot of each shard below `path`/shard=K, ordered by slot."""
    placed = interleave(docs, **settings)
    ordered = placed.repartition("shard", F.floor(F.col("slot") / SLICE_ROWS)).sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
