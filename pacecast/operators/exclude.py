"""Date ranges taken out of training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_config(exclusions: DataFrame) -> DataFrame:
    """Each hotel's newest entries, ties kept."""
    newest = exclusions.groupBy("HotelID").agg(F.max("ts").alias("ts"))
    return exclusions.join(newest, ["HotelID", "ts"], "left_semi")


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Each hotel's ranges as disjoint ones: overlapping and touching ranges become one.

    The farthest end of each start is an aggregate in every task first, so that a hotel enters the window with at most
    one row a calendar day, however many ranges it has. Ranges without a hotel, start or end, or that end before they
    start, hold no day and go.
    """
    by_start = (
        ranges.where(F.col("HotelID").isNotNull() & (F.col("range_start") <= F.col("range_end")))
        .groupBy("HotelID", "range_start")
        .agg(F.max("range_end").alias("range_end"))
    )
    in_order = Window.partitionBy("HotelID").orderBy("range_start")
    reached = F.max("range_end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("range_start") > F.date_add(reached, 1), F.lit(True))
    numbered = by_start.withColumn("_apart", apart.cast("int")).withColumn("_island", F.sum("_apart").over(in_order))
    merged = numbered.groupBy("HotelID", "_island")
    return merged.agg(F.min("range_start").alias("range_start"), F.max("range_end").alias("range_end")).drop("_island")


def _last_start(ranges: Column, day: Column) -> Column:
    """How many of the sorted ranges start on or before the day, by halving."""
    halvings = F.ceil(F.log2(F.size(ranges) + 1)).cast("int")
    start = F.struct(F.lit(0).alias("lo"), F.size(ranges).alias("hi"))

    def halve(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        open_, before = acc["lo"] < acc["hi"], F.get(ranges, mid)["range_start"] <= day
        return F.struct(
            F.when(open_ & before, mid + 1).otherwise(acc["lo"]).alias("lo"),
            F.when(open_ & ~before, mid).otherwise(acc["hi"]).alias("hi"),
        )

    return F.aggregate(F.sequence(F.lit(1), halvings), start, halve, lambda acc: acc["lo"])


def drop_excluded(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Drop stays inside any range of their hotel, both ends included; rows without hotel or stay date are kept.

    A hotel's disjoint ranges (at most one for two calendar days) meet its stays as one sorted array, which a stay
    searches by halving. The planner broadcasts the arrays when their size allows; else it shuffles by hotel and may
    split a big hotel's left side.
    """
    listed = merged_ranges(ranges).groupBy(F.col("HotelID").alias("_hotel")).agg(
        F.sort_array(F.collect_list(F.struct("range_start", "range_end"))).alias("_ranges")
    )
    joined = df.join(listed, F.col("HotelID") == F.col("_hotel"), "left")
    end = F.get("_ranges", _last_start(F.col("_ranges"), F.col("stay_date")) - 1)["range_end"]
    inside = F.col("_ranges").isNotNull() & F.col("stay_date").isNotNull() & (F.col("stay_date") <= end)
    return joined.where(~F.coalesce(inside, F.lit(False))).drop("_hotel", "_ranges")
