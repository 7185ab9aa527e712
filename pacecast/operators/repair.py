"""Repair of predicted paths: gaps filled, no dips, ordered bands, capacity cap.

The array form works inside one row and needs no shuffle; the long form does the same over windows for
forecasts already stored as rows. A path has at most one row a day, so its window is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacecast.functions import arrays as A


def _shift(median: Column, first: Column) -> Column:
    """How far the upper band moves with its median. The absolute value is deliberate: it matters below zero."""
    return F.greatest(median, first) - F.abs(median)


# Fixed value: what readers of the results look for.
NO_ROOMS = "available_rooms must be provided"


def _capped(value: Column, rooms: Column, strict: bool) -> Column:
    """Null where the rooms are unknown: such a path fails alone, or (strict) ends the job."""
    missing = F.lit(None).cast("double")
    if strict:
        missing = F.raise_error(F.lit(NO_ROOMS)).cast("double")
    return F.when(rooms.isNull(), missing).when(value > rooms, rooms.cast("double")).otherwise(value)


def repair_arrays(df: DataFrame, capacity: str | None = None, strict: bool = False) -> DataFrame:
    """Add y_med, y_upper, y_lower next to the untouched *_raw paths."""
    filled = df.withColumn("_fill", A.fill_linear(F.col("y_med_raw")))
    first = F.get("_fill", F.lit(0))
    out = filled.withColumn("y_med", A.running_max(F.col("_fill")))
    lifted = F.zip_with("y_upper_raw", "_fill", lambda u, m: u + _shift(m, first))
    out = out.withColumns(
        {
            "y_upper": F.zip_with(lifted, F.col("y_med"), lambda u, m: F.when(u < m, m).otherwise(u)),
            "y_lower": F.zip_with("y_lower_raw", "y_med", lambda v, m: F.when(v > m, m).otherwise(v)),
        }
    ).drop("_fill")
    if capacity is not None:
        out = out.withColumns(
            {
                c: F.transform(c, lambda v: _capped(v, F.col(capacity), strict))
                for c in ("y_med", "y_upper", "y_lower")
            }
        )
    return out


def fill_rows(df: DataFrame, path, order: str, value: str) -> DataFrame:
    """Linear fill of nulls along stored paths; the ends copy the nearest known value."""
    w = Window.partitionBy(*path).orderBy(order)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("i"), F.col(value).alias("x")))
    before = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    marked = df.withColumns({"_before": before, "_after": after})
    line = F.col("_before.x") + F.try_divide(
        (F.col("_after.x") - F.col("_before.x")) * (F.col(order) - F.col("_before.i")),
        F.col("_after.i") - F.col("_before.i"),
    )
    return marked.withColumn(
        value, F.coalesce(F.col(value), line, F.col("_before.x"), F.col("_after.x"))
    ).drop("_before", "_after")


def repair_rows(df: DataFrame, path, order: str = "day_index") -> DataFrame:
    """Dip repair of stored paths; y_med, y_upper, y_lower are replaced, raw values kept as *_raw."""
    w = Window.partitionBy(*path).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    raw = df.withColumns({f"{c}_raw": F.col(c) for c in ("y_med", "y_upper", "y_lower")})
    lifted = F.col("y_upper") + _shift(F.col("y_med"), F.col("_first"))
    top = raw.withColumns({"_top": F.max("y_med").over(w), "_first": F.first("y_med").over(w)})
    return top.withColumns(
        {
            "y_med": F.col("_top"),
            "y_upper": F.when(lifted < F.col("_top"), F.col("_top")).otherwise(lifted),
            "y_lower": F.when(F.col("y_lower") > F.col("_top"), F.col("_top")).otherwise(F.col("y_lower")),
        }
    ).drop("_top", "_first")


def cap_rows(df: DataFrame, rooms: str = "available_rooms", strict: bool = True) -> DataFrame:
    """No forecast above the hotel's rooms; a hotel without a room count is an error, or (not strict) reads null."""
    return df.withColumns({c: _capped(F.col(c), F.col(rooms), strict) for c in ("y_med", "y_upper", "y_lower")})
