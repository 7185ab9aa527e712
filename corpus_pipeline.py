"""From raw documents to token ids: five stages, each over all that the one before kept.

Toxic documents go; of each near-duplicate group one document stays; documents that hold a benchmark window go; personal
data is replaced by its kind; what is left is encoded. All but the last stage return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacecast.llm import decontam, pii, simhash, sptok, toxicity
from pacecast.llm.common import staged, table
from pacecast.llm.queries import PIECES, TOXIC_FROM, remainder

ROW = "_pipeline_row"


def numbered(docs: DataFrame) -> DataFrame:
    """Rows with a number of their own, fixed by writing them, so that a verdict finds its row whatever doc_id holds."""
    return staged(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def as_ids(rows: DataFrame) -> DataFrame:
    """The row number in the place of doc_id, for operators that answer by doc_id."""
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def only(rows: DataFrame, keep: DataFrame, columns: list[str]) -> DataFrame:
    """The rows whose number is in keep(doc_id)."""
    return rows.join(keep.select(F.col("doc_id").alias(ROW)), ROW, "left_semi").select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below TOXIC_FROM; empty and null texts score as ordinary and stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    return toxicity.kept_rows(docs, model, TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest doc_id (nulls last; repeated rows: any one)."""
    rows = numbered(docs)
    found = simhash.near_duplicates(as_ids(rows)).select(F.col("doc_id").alias(ROW), "component_id")
    named = rows.select(ROW, F.col("doc_id").alias("_id")).join(found, ROW)
    # The smallest of a group is an aggregate, so a large group is summed up in every task first.
    best = named.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull(), "_id", ROW)).alias("first"))
    return only(rows, best.select(F.col(f"first.{ROW}").alias("doc_id")), docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    rows = numbered(docs)
    hits = decontam.decontaminate(as_ids(rows), table(spark, sf_dir, "benchmark"))
    return only(rows, hits.where("n_hit = 0"), docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in the text, n_chars following; texts without any stay as they are."""
    return pii.redacted(docs, pii.train())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (end id last) and the text they decode to."""
    return sptok.encode_decode(docs, public_tokenizers.path(PIECES))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("personal_data", redact),
    ("sentencepiece", encode),
]

#: SQL can express neither the models nor the tokenizer; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
