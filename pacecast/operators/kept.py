"""Kept cells: booking totals that a day's changes are added to, instead of reading all bookings each run.

A cell is what one hotel and stay has at one lead and one cancellation lead (gone; -1 = never). A period's changes are
signed: a booking adds to its cell; an earlier booking that is cancelled leaves the cell it stood in for another. A folder
keeps one partition a period, named by its last day. Its sum up to a day is the state of that day, so a repeated or
mended period replaces its own partition alone, and the state of an earlier day can still be read.

`n` counts the bookings of a cell, so that a cell is empty exactly when n is 0, whatever the rounding of sums.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacecast.operators.pace import KEYS
from pacecast.sources import sinks

CELL = (*KEYS, "lead", "gone")
AMOUNTS = ("n", "revenue", "rooms")


def changes(aware: DataFrame, after: date | None, through: date) -> DataFrame:
    """Signed cells of what happened after `after` (None: ever) up to and including `through`.

    `aware` needs only the bookings made or cancelled in the period; others count for nothing. A booking cancelled
    before it was made counts as cancelled from the start. Rows without hotel, stay or booking date have no cell.
    """
    made = F.col("confirmation_date")
    left = F.when(F.col("cancellation_date").isNotNull(), F.greatest("cancellation_date", made))
    gone = F.datediff("stay_date", "cancellation_date")

    def within(day):
        return (day <= F.lit(through)) & (F.lit(True) if after is None else day > F.lit(after))

    def entry(where, sign):
        return F.struct(where.cast("int").alias("gone"), F.lit(sign).alias("sign"))

    now = F.when(left <= F.lit(through), gone).otherwise(F.lit(-1))
    moved = F.lit(False) if after is None else (made <= F.lit(after)) & F.coalesce(within(left), F.lit(False))
    entries = F.when(within(made), F.array(entry(now, 1))).when(moved, F.array(entry(F.lit(-1), -1), entry(gone, 1)))
    rows = aware.where(F.col("HotelID").isNotNull() & F.col("stay_date").isNotNull()).select(
        *KEYS, F.datediff("stay_date", made).alias("lead"), "revenue", "rooms", F.explode(entries).alias("_e")
    )
    sign = F.col("_e.sign")
    return rows.groupBy(*KEYS, "lead", F.col("_e.gone").alias("gone")).agg(
        F.sum(sign).alias("n"), *[F.sum(sign * F.col(c).cast("double")).alias(c) for c in AMOUNTS[1:]]
    )


def record(changed: DataFrame, path: str, through: date) -> None:
    """Put a period's changes in its own partition, replacing what an earlier try left there."""
    sinks.replace_parts(changed.withColumn("through", F.lit(through)), path, ("through",), spread=("HotelID",))


def state(spark: SparkSession, path: str, through: date | None = None) -> DataFrame:
    """The cells that hold a booking after all periods up to `through` (None: all)."""
    periods = spark.read.parquet(path)
    if through is not None:
        periods = periods.where(F.col("through") <= F.lit(through))
    return periods.groupBy(*CELL).agg(*[F.sum(c).alias(c) for c in AMOUNTS]).where(F.col("n") != 0)


def compact(spark: SparkSession, path: str, through: date, target: str) -> None:
    """Copy the folder to a new one in which all periods up to `through` are one; the old folder stays as it is."""
    record(state(spark, path, through), target, through)
    later = spark.read.parquet(path).where(F.col("through") > F.lit(through))
    sinks.replace_parts(later, target, ("through",), spread=("HotelID",))


def as_bookings(cells: DataFrame) -> DataFrame:
    """Cells as rows that the training plan reads in the place of bookings, one a cell instead of one a booking."""
    return cells.select(
        *KEYS,
        F.date_sub("stay_date", F.col("lead")).alias("confirmation_date"),
        F.when(F.col("gone") >= 0, F.date_sub("stay_date", F.col("gone"))).alias("cancellation_date"),
        "revenue",
        "rooms",
    )
