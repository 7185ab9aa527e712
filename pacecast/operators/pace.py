"""Booking pace: what was on the books at each lead, per hotel and stay date.

Bookings are summed map-side by (hotel, stay, lead, cancellation lead) before anything moves, then one stay's
cells (a bounded number, see functions.arrays) meet in one row. All later work, snapshots included, is
narrow: targets, lags and calendar join on (hotel, stay) first and snapshots are exploded last, so the big
exploded rows never cross a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pacecast.functions import arrays as A

KEYS = ("HotelID", "stay_date")


def running_total(daily: DataFrame, value: str, out: str = "cum_sum_value") -> DataFrame:
    """Running sum along the booking axis, with the lead in days. `daily` is unique on hotel, stay and
    confirmation date, so a window holds at most one row a day."""
    booked = Window.partitionBy(*KEYS).orderBy("confirmation_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        *KEYS,
        "confirmation_date",
        F.datediff("stay_date", "confirmation_date").alias("booking_lead"),
        F.sum(value).over(booked).alias(out),
    )


def work_tasks(spark: SparkSession) -> int:
    """Partitions for steps that turn few bytes into much work. The number is fixed, as adaptive execution
    merges partitions by bytes and would leave such a step on a few cores. It follows the session's own
    shuffle settings, and never falls below four tasks a core."""
    planned = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    shuffles = int(planned or spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffles, 4 * spark.sparkContext.defaultParallelism)


def stay_cells(
    bookings: DataFrame, value: str | Column, lead_window: int, snapshots: int = 1, tasks: int | None = None
) -> DataFrame:
    """One row per hotel and stay: `cells`, sorted from the farthest lead.

    Rows without hotel or stay go at once. Joins would drop them later in some branches only, and branches
    that differ cannot share the shuffle.

    The repartition is the shuffle that the second sum needs anyway; it only fixes the number of tasks.

    Leads past the window count in all slots, so they share its last lead; cancellations at or before the
    last snapshot are never on the books and share one mark. Rows marked `target_only` get a mark of their own, -2.
    """
    amount = F.col(value) if isinstance(value, str) else value
    lead = F.least(F.datediff("stay_date", "confirmation_date"), F.lit(lead_window - 1))
    gone = F.lit(-1)
    if "cancellation_date" in bookings.columns:
        days = F.least(F.datediff("stay_date", "cancellation_date"), F.lit(max(snapshots - 1, 0)))
        gone = F.when(F.col("cancellation_date").isNull(), F.lit(-1)).otherwise(days)
    if "target_only" in bookings.columns:
        gone = F.when(F.col("target_only"), F.lit(-2)).otherwise(gone)
    summed = (
        bookings.select(*KEYS, lead.alias("lead"), gone.alias("gone"), amount.cast("double").alias("amount"))
        .where((F.col("lead") >= 0) & F.col("HotelID").isNotNull() & F.col("stay_date").isNotNull())
        .groupBy(*KEYS, "lead", "gone")
        .agg(F.sum("amount").alias("amount"))
    )
    spread = summed.repartition(tasks or work_tasks(bookings.sparkSession), *KEYS)
    return spread.groupBy(*KEYS).agg(
        F.sort_array(F.collect_list(F.struct("lead", "gone", "amount")), asc=False).alias("cells")
    )


def pace(bookings: DataFrame, value: str | Column, lead_window: int, out: str = "pace") -> DataFrame:
    """Pace array over all given bookings: slot l = amount booked at least l days before the stay."""
    plain = bookings.drop("cancellation_date")
    return stay_cells(plain, value, lead_window).select(*KEYS, A.pace_between(F.col("cells"), 0, lead_window).alias(out))


def target_pace(confirmed: DataFrame, value: str | Column, lead_window: int) -> DataFrame:
    return pace(confirmed, value, lead_window, out="target")


def split_cells(stays: DataFrame, lead_window: int) -> DataFrame:
    """Cells as the lasting pace (never cancelled, worked out once a stay) and the cancelled cells."""
    cells = F.col("cells")
    return stays.withColumns(
        {"lasting": A.pace_between(A.confirmed_cells(cells), 0, lead_window), "gone": A.gone_cells(cells)}
    ).drop("cells")


def explode_snapshots(stays: DataFrame, lead_window: int, snapshots: int, first: int = 0) -> DataFrame:
    """One row per snapshot k: the pace as it looked k days before the stay, cancellations up to then gone."""
    keep = [c for c in stays.columns if c != "cells"]
    seen = A.snapshots_between(F.col("lasting"), F.col("gone"), first, snapshots - 1)
    spread = split_cells(stays, lead_window).select(*keep, F.posexplode(seen).alias("_at", "pace"))
    return spread.select(*keep, (F.col("_at") + first).alias("forecast_index"), "pace")


def snapshot_pace(aware: DataFrame, value: str | Column, lead_window: int, snapshots: int) -> DataFrame:
    """Cancel-aware pace per hotel, stay and snapshot."""
    return explode_snapshots(stay_cells(aware, value, lead_window, snapshots), lead_window, snapshots)


def join_targets(targets: DataFrame, features: DataFrame) -> DataFrame:
    """Targets meet their snapshots, one stay to many."""
    return targets.join(features, list(KEYS), "inner")


def adr_pace(bookings: DataFrame, lead_window: int) -> DataFrame:
    """Average daily rate on the books: revenue pace over rooms pace, null before the first room."""
    revenue = pace(bookings, "revenue", lead_window, "_revenue")
    rooms = pace(bookings, "rooms", lead_window, "_rooms")
    return revenue.join(rooms, list(KEYS)).select(*KEYS, F.zip_with("_revenue", "_rooms", F.try_divide).alias("pace"))


def trim_to_hotel(df: DataFrame, column: str = "pace", window: str = "lead_window") -> DataFrame:
    return df.withColumn(column, A.trim_pace(F.col(column), F.col(window)))


def widen(df: DataFrame, prefix: str, n_pace: int, n_target: int = 0, keep=()) -> DataFrame:
    """Edge export: arrays to columns RV0, RV1, ... and RV0_tgt, ..."""
    slots = [F.get("pace", F.lit(i)).alias(f"{prefix}{i}") for i in range(n_pace)]
    targets = [F.get("target", F.lit(i)).alias(f"{prefix}{i}_tgt") for i in range(n_target)]
    return df.select(*keep, *targets, *slots)
