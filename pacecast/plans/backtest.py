"""Sliding backtest: all origins in one job."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacecast.config import RunConfig
from pacecast.functions import arrays as A
from pacecast.functions.metrics import target_column
from pacecast.operators import features, fit, pace, predict, results


def origins_of(stay: str, first: date, last: date, step: int, horizon: int):
    """Origins first, first + step, ... <= last that see a stay 1..horizon days ahead, as an array column.

    A stay has at most horizon / step + 1 of them, so exploding it replaces the cross of origins and data.
    """
    days = F.datediff(stay, F.lit(first))
    low = F.greatest(F.ceil((days - horizon) / step), F.lit(0)).cast("int")
    high = F.least(F.floor((days - 1) / step), F.lit((last - first).days // step)).cast("int")
    numbers = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda k: F.date_add(F.lit(first), k * step))


def sliding_rows(confirmed: DataFrame, config: RunConfig, first: date, last: date, step: int) -> DataFrame:
    """Model rows of every origin: what was on the books at the origin, and the truth for the rest of the path."""
    value = target_column(config.target_type)
    ahead = F.col("stay_date").between(F.lit(first + timedelta(days=1)), F.lit(last + timedelta(days=config.horizon)))
    stays = pace.stay_cells(confirmed.where(ahead).drop("cancellation_date"), value, config.lead_window)
    spread = stays.withColumn("eval_start", F.explode(origins_of("stay_date", first, last, step, config.horizon)))
    spread = spread.withColumns(
        {"eval_end": F.date_add("eval_start", config.horizon), "_ahead": F.datediff("stay_date", "eval_start")}
    )
    # a stay with nothing booked at the origin was not in the data then
    known = spread.where(F.exists("cells", lambda c: c["lead"] >= F.col("_ahead")))
    return _rows(known, config, F.array("_ahead"), keep=("eval_start", "eval_end"))


def _rows(stays: DataFrame, config: RunConfig, distances, keep=()) -> DataFrame:
    """Rows of confirmed-only cells: they carry no cancellation, so every snapshot keeps them all."""
    stays = stays.withColumn("target", A.pace_between(F.col("cells"), 0, config.horizon))
    return features.rows_from_cells(stays, distances, config.lead_window, (), config.pace_features, keep=keep)


def fit_before(confirmed: DataFrame, config: RunConfig, first: date, method: str = "pickup") -> DataFrame:
    """Parameters from stays that were over at the first origin; one model serves all origins."""
    value = target_column(config.target_type)
    done = confirmed.where(F.col("stay_date") <= F.lit(first)).drop("cancellation_date")
    rows = _rows(pace.stay_cells(done, value, config.lead_window), config, config.distances)
    if method == "pickup":
        return fit.pickup_fit(rows, config.quantiles)
    return fit.linear_fit(rows, config.quantiles, recursive=config.recursive)


def backtest(
    confirmed: DataFrame, config: RunConfig, first: date, last: date, step: int, method: str = "pickup"
) -> DataFrame:
    """Long backtest rows: prediction and truth for each point of each path of each origin."""
    forecast = predict.pickup_predict if method == "pickup" else predict.linear_predict
    predicted = forecast(
        sliding_rows(confirmed, config, first, last, step), fit_before(confirmed, config, first, method), config.quantiles
    )
    long = results.explode_path(
        predicted, "y_med_raw", "y", keep=("HotelID", "stay_date", "eval_start", "eval_end")
    )
    return long.select(
        "HotelID",
        "stay_date",
        "eval_start",
        "eval_end",
        "booking_index",
        F.col("y_med_raw").alias("y_pred"),
        F.col("y").alias("y_true"),
        F.lit(config.without_pms).alias("pms_sync_off"),
        F.lit("complete").alias("status"),
    )


def origin_list(first: date, last: date, step: int) -> list[date]:
    return [first + timedelta(days=i) for i in range(0, (last - first).days + 1, step)]
