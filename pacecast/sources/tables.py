"""Readers. A source is a parquet folder or a catalog table; every reader prunes columns and pushes filters."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacecast import schema as S

#: What lets Spark answer a maximum from parquet footers.
FOOTER_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def read_table(spark: SparkSession, source: str, schema=None) -> DataFrame:
    """Read a parquet path (anything with a slash) or a catalog table, checked against its schema.

    A partition column of digits would be read as a number; where the schema says text, "007" stays what it is.
    """
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    if schema is None:
        return df
    last = df.schema.fields[-1]  # partition columns come last
    if "/" in source and last.name in schema.fieldNames() and last.dataType != schema[last.name].dataType == T.StringType():
        df = spark.read.schema(T.StructType([*df.schema.fields[:-1], schema[last.name]])).parquet(source)
    return S.validate(df, schema)


def read_bookings(spark: SparkSession, source: str) -> DataFrame:
    return read_table(spark, source, S.BOOKINGS)


def confirmed_scan(bookings: DataFrame, columns, status: str = "Confirmed") -> DataFrame:
    """Pruned scan with the status filter pushed to the file reader."""
    return bookings.where(F.col("status") == status).select(*columns)


def hotel_dimension(hotels: DataFrame, columns=("HotelID", "HotelName"), distinct: bool = True) -> DataFrame:
    picked = hotels.select(*columns)
    return picked.distinct() if distinct else picked


def clean_hotels(hotels: DataFrame) -> DataFrame:
    """Drop hotels without id; states only count in the US and Canada, elsewhere they read N/A."""
    has_state = F.coalesce(F.col("Country").isin("US", "CA"), F.lit(False))
    return hotels.dropna(subset=["HotelID"]).withColumn(
        "State", F.when(has_state, F.col("State")).otherwise("N/A")
    )


def short_name(hotels: DataFrame, length: int = 20) -> DataFrame:
    return hotels.withColumn("HotelName", F.substring("HotelName", 1, length))


def statuses(lookup: DataFrame, scenario: str) -> DataFrame:
    return lookup.where(F.col("scenario") == scenario).select("status")


def calendar_scan(calendar: DataFrame, start: date, end: date | None = None, column: str = "stay_date") -> DataFrame:
    df = calendar.where(F.col(column) >= F.lit(start))
    return df if end is None else df.where(F.col(column) <= F.lit(end))


def forecast_scan(forecasts: DataFrame, eval_start: date) -> DataFrame:
    return forecasts.where(F.col("stay_date") >= F.lit(eval_start))


def exclusion_scan(exclusions: DataFrame, pipeline: str, hotels: DataFrame | None = None) -> DataFrame:
    df = exclusions.where(F.col("pipeline") == pipeline)
    return df if hotels is None else df.join(hotels.select("HotelID").distinct(), "HotelID", "left_semi")


def read_exclusions(spark: SparkSession, source: str) -> DataFrame:
    """A missing exclusion table means that nothing is excluded."""
    try:
        return read_table(spark, source, S.EXCLUSIONS)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return spark.createDataFrame([], S.EXCLUSIONS)
        raise


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with the file they stand in."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def read_log_blocks(spark: SparkSession, path: str) -> DataFrame:
    """As read_logs, with `block`, the offset of the piece of the file that one task reads: a large file is many pieces."""
    block = F.col("_metadata.file_block_start").alias("block")
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), block, "value")


def unknown_hotels(requested: DataFrame, hotels: DataFrame) -> DataFrame:
    """All requested hotels that the dimension does not know."""
    return requested.select("HotelID").distinct().join(hotels, "HotelID", "left_anti")


def require_hotels(requested: DataFrame, hotels: DataFrame) -> None:
    """Raise for requested hotels that the dimension does not know. Runs one small job on the request list."""
    unknown = unknown_hotels(requested, hotels)
    first = [r.HotelID for r in unknown.orderBy("HotelID").limit(20).collect()]
    if first:
        raise ValueError(f"{unknown.count()} unknown hotel ids, the first: {first}")


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Stop early on an empty table; looks for one row instead of counting."""
    if df.isEmpty():
        raise ValueError(f"{name} is empty")
    return df


def footer_watermark(spark: SparkSession, path: str, column: str = "confirmation_date") -> date | None:
    """The latest date of a parquet folder, from the statistics in its files' footers: no column is read.

    A session of its own asks for it, so the caller's settings stay. Spark itself reads the column where the
    statistics cannot answer by type; where files were written without statistics it says so, and the column is
    read here.
    """
    footers = spark.newSession()
    for key, value in FOOTER_SETTINGS.items():
        footers.conf.set(key, value)
    try:
        return latest_in(footers, path, column).first()[0]
    except Exception as err:
        if "aggregatePushdown" not in str(err):
            raise
        return latest_in(spark, path, column).first()[0]


def latest_in(spark: SparkSession, path: str, column: str) -> DataFrame:
    return spark.read.parquet(path).agg(F.max(column))
