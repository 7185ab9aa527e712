"""Writers. Tables are parquet, partitioned by hotel where readers select hotels.

Before a partitioned write the rows are rebalanced by hotel: one hotel goes to few files, and adaptive
execution splits a hotel that is too big for one task.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def rebalance(df: DataFrame, *keys: str) -> DataFrame:
    return df.hint("rebalance", *keys)


def _save(writer, target: str, path: str | None = None) -> None:
    if "/" in target:
        writer.parquet(target)
    else:
        (writer.option("path", path) if path else writer).format("parquet").saveAsTable(target)


def overwrite(df: DataFrame, target: str, partition_by: str | None = "HotelID", spread: bool = True) -> None:
    """Replace a table or folder."""
    df = rebalance(df, partition_by) if partition_by and spread else df
    writer = df.write.mode("overwrite")
    _save(writer.partitionBy(partition_by) if partition_by else writer, target)


def append(
    df: DataFrame, target: str, partition_by: str | None = "HotelID", path: str | None = None, spread: bool = True
) -> None:
    """Add rows to a table or folder; `path` puts a new table's files at an external place."""
    df = rebalance(df, partition_by) if partition_by and spread else df
    writer = df.write.mode("append")
    _save(writer.partitionBy(partition_by) if partition_by else writer, target, path)


def append_metrics(df: DataFrame, target: str) -> None:
    append(df, target, partition_by=None)


def replace_parts(
    df: DataFrame, target: str, keys: tuple[str, ...] = ("run_id", "HotelID"), spread: tuple[str, ...] | None = None
) -> None:
    """Replace the partitions that df has rows for and leave all others: writing again gives the same folder.

    A run that failed half way, or a hotel that is forecast anew, is mended by writing its rows once more; nothing is
    read first. A partition that df has no row for stays as it was. `spread` names other columns to rebalance by.
    """
    writer = rebalance(df, *(spread or keys)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(target)


def rebuild(df: DataFrame, table: str) -> None:
    """Drop a catalog table if it is there and write it anew."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    append(df, table, partition_by=None)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the one the cluster names for checkpoints."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a shared folder, or pass a staging path")
    return root.rstrip("/")


def existing(spark: SparkSession, target: str) -> DataFrame | None:
    """The table or folder as it is, or None."""
    try:
        return spark.read.parquet(target) if "/" in target else spark.table(target)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a staged folder once nothing reads it any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write once, read back: later steps start from files, and lost executors re-read instead of re-fit.

    The caller owns the folder and removes it with `drop_stage`.
    """
    spark = df.sparkSession
    path = path or f"{staging_root(spark)}/stage-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
