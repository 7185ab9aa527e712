"""Forecasts against actuals: alignment, error rows, triangles, backtest metrics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacecast.config import PMS_CHANNEL
from pacecast.functions.metrics import absolute_error, sape
from pacecast.operators.clean import daily_net, preprocess
from pacecast.operators.pace import running_total

RUN = "timestamp"  # tells the runs of a forecast table apart
TRIANGLE_KEYS = ("pms_sync_off", "target_type", "HotelID", "day_ahead_index", "booking_index")


def actuals(confirmed: DataFrame, eval_start: date | None, value: str) -> DataFrame:
    """What was on the books at every confirmation date, with and without the PMS channel."""
    return actuals_by_target(confirmed, eval_start, {value: value}).drop("target_type")


def actuals_by_target(confirmed: DataFrame, eval_start: date | None, values: dict[str, str]) -> DataFrame:
    """Actuals of several targets (name: column), with and without the PMS channel.

    All targets and flags come from one scan, one sum and one window; rows are multiplied only at the end.
    """
    direct = ~F.col("channel").eqNullSafe(PMS_CHANNEL)
    sums = [F.sum(c).alias(f"all_{c}") for c in values.values()]
    sums += [F.sum(F.when(direct, F.col(c))).alias(f"direct_{c}") for c in values.values()]
    daily = (
        preprocess(confirmed, eval_start)
        .groupBy("HotelID", "stay_date", "confirmation_date")
        .agg(*sums, F.count(F.when(direct, F.lit(1))).alias("n_direct"))
    )
    booked = (
        Window.partitionBy("HotelID", "stay_date")
        .orderBy("confirmation_date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    names = [f"{kind}_{c}" for kind in ("all", "direct") for c in values.values()]
    both = daily.withColumns({n: F.sum(n).over(booked) for n in names})

    def flags(off: bool, kind: str):
        return [
            F.struct(F.lit(t).alias("target_type"), F.lit(off).alias("pms_sync_off"), F.col(f"{kind}_{c}").alias("y_true"))
            for t, c in values.items()
        ]

    every, alone = flags(False, "all"), flags(True, "direct")
    kept = F.when(F.col("n_direct") > 0, F.array(*every, *alone)).otherwise(F.array(*every))
    return both.select(
        "HotelID",
        "stay_date",
        "confirmation_date",
        F.datediff("stay_date", "confirmation_date").alias("booking_lead"),
        F.inline(kept),
    )


def actuals_one_flag(confirmed: DataFrame, eval_start: date | None, value: str, without_pms: bool) -> DataFrame:
    daily = daily_net(preprocess(confirmed, eval_start, without_pms))
    return running_total(daily, value, out="y_true").withColumn("pms_sync_off", F.lit(without_pms))


def union_targets(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def align(forecasts: DataFrame, run: str = RUN) -> DataFrame:
    """Forecasts after their origin, the first booking date of their run. A run's path is short, so its window is."""
    path = [c for c in ("pms_sync_off", run, "HotelID", "stay_date", "target_type") if c in forecasts.columns]
    origin = F.min("booking_date").over(Window.partitionBy(*path))
    return (
        forecasts.withColumn("origin_date", origin)
        .where(F.col("booking_date") > F.col("origin_date"))
        .withColumns(
            {
                "day_ahead_index": F.datediff("stay_date", "origin_date"),
                "booking_index": F.col("day_index"),
            }
        )
        .withColumnsRenamed({"booking_date": "confirmation_date", "y_med": "y_pred"})
    )


def join_actuals(aligned: DataFrame, actual: DataFrame) -> DataFrame:
    keys = ["HotelID", "stay_date", "confirmation_date", "pms_sync_off"]
    keys += ["target_type"] if "target_type" in aligned.columns else []
    return aligned.join(actual.select(*keys, "y_true"), keys, "left")


def known_actuals(df: DataFrame) -> DataFrame:
    return df.where(F.col("y_true").isNotNull() & (F.col("y_true") != 0))


def score(forecasts: DataFrame, actual: DataFrame, target_type: str, run: str = RUN) -> DataFrame:
    """Error rows of one target type; the run's own column is kept."""
    tagged = (df.withColumn("target_type", F.lit(target_type)) for df in (forecasts, actual))
    return score_targets(*tagged, run)


def score_targets(forecasts: DataFrame, actual: DataFrame, run: str = RUN) -> DataFrame:
    """Error rows of forecasts and actuals that carry their target type."""
    joined = known_actuals(join_actuals(align(forecasts, run), actual))
    return joined.select(
        "HotelID",
        "stay_date",
        "confirmation_date",
        "day_ahead_index",
        "booking_index",
        "y_pred",
        "y_true",
        "pms_sync_off",
        run,
        sape(F.col("y_true"), F.col("y_pred")).alias("SAPE"),
        "target_type",
    )


def with_bounds(df: DataFrame, eval_start: date, eval_end: date, scored_at: Column | None = None) -> DataFrame:
    """Stamp rows with their evaluation window and score time."""
    return df.withColumns(
        {
            "eval_start_date": F.lit(eval_start),
            "eval_end_date": F.lit(eval_end),
            "scored_at": F.current_timestamp() if scored_at is None else scored_at,
        }
    )


def mean_errors(rows: DataFrame, *metrics: str) -> DataFrame:
    return rows.groupBy(*TRIANGLE_KEYS).agg(*[F.avg(m).alias(m) for m in metrics or ("SAPE",)])


def melt(wide: DataFrame, keys, metrics) -> DataFrame:
    return wide.unpivot([F.col(k) for k in keys], [F.col(m) for m in metrics], "variable", "value")


def triangle(rows: DataFrame, *metrics: str) -> DataFrame:
    metrics = metrics or ("SAPE",)
    return melt(mean_errors(rows, *metrics), TRIANGLE_KEYS, metrics)


def triangle_grid(melted: DataFrame, days: int) -> DataFrame:
    """Triangle as a grid: one row per booking index, one column per day ahead. Columns are given, not discovered."""
    wide = melted.groupBy("HotelID", "pms_sync_off", "target_type", "variable", "booking_index")
    grid = wide.pivot("day_ahead_index", list(range(1, days + 1))).agg(F.first("value"))
    return grid.withColumnsRenamed({str(d): f"d{d}" for d in range(1, days + 1)})


def metric_range(melted: DataFrame) -> DataFrame:
    return melted.groupBy("HotelID").agg(F.min("value").alias("value_min"), F.max("value").alias("value_max"))


def path_metrics(backtest: DataFrame, points=(7, 14, 28)) -> DataFrame:
    """SMAPE@N and MAE@N over the first N points of each path, all N in one pass."""
    at = []
    for n in points:
        inside = F.col("booking_index") < n
        at.append(F.avg(F.when(inside, sape(F.col("y_true"), F.col("y_pred")))).alias(f"SMAPE{n}"))
        at.append(F.avg(F.when(inside, absolute_error(F.col("y_true"), F.col("y_pred")))).alias(f"MAE{n}"))
    return backtest.groupBy("HotelID", "stay_date", "eval_start", "eval_end").agg(*at)


def name_metrics(metrics: DataFrame, hotels: DataFrame) -> DataFrame:
    """Add hotel names; the planner broadcasts the names when their size allows."""
    return metrics.join(hotels.select("HotelID", "HotelName"), "HotelID", "inner")


def metric_summary(named: DataFrame, metrics) -> DataFrame:
    """Means by hotel, by window and hotel, and by window, in one pass."""
    hotel, window = ["HotelID", "HotelName"], ["eval_start", "eval_end"]
    sets = [[F.col(c) for c in s] for s in (hotel, window + hotel, window)]
    keys = [F.col(c) for c in window + hotel]
    return named.groupingSets(sets, *keys).agg(*[F.avg(m).alias(m) for m in metrics])


def holdout_metrics(rows: DataFrame) -> DataFrame:
    return rows.groupBy("HotelID").agg(
        F.avg(sape(F.col("y_true"), F.col("y_pred"))).alias("SMAPE"),
        F.avg(absolute_error(F.col("y_true"), F.col("y_pred"))).alias("MAE"),
    )
