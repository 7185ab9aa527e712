"""Bookings and parameters to published forecasts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pacecast.config import RunConfig
from pacecast.functions import arrays as A
from pacecast.functions.metrics import target_column
from pacecast.operators import clean, features, pace, predict, repair, results
from pacecast.sources import sinks

# Fixed value: what readers of the results look for.
NO_VERSION = "no model version for the stage"
NO_DATA = "The input data is empty and cannot proceed with prediction"
SETTINGS = ("lead_window", "inference_length", "available_rooms", "forecast_currency")


def inference_matrix(
    confirmed: DataFrame,
    config: RunConfig,
    hotels: DataFrame,
    start: date | Column,
    holidays: DataFrame | None = None,
    with_features: bool = True,
) -> DataFrame:
    """Stays after `start` with the pace known at `start`, days ahead, settings, calendar and lags.

    The window is as long as the longest inference length; rows past a hotel's own length are dropped. Pickup
    forecasts read no lags or calendar, so they may do without `with_features`.
    """
    value = target_column(config.target_type)
    first = start if isinstance(start, Column) else F.lit(start)
    longest = hotels.agg(F.max("inference_length")).scalar()
    widest = hotels.agg(F.max("lead_window")).first()[0]
    if widest is not None and widest > config.lead_window:
        raise ValueError(f"a hotel's lead window of {widest} passes the configured {config.lead_window}")
    open_stays = clean.test_window(confirmed, first, F.date_add(first, longest))
    matrix = pace.pace(open_stays, value, config.lead_window)
    matrix = clean.attach_config(features.days_ahead(matrix, first), hotels, *SETTINGS)
    matrix = matrix.where(F.col("day_ahead") <= F.col("inference_length"))
    matrix = matrix.withColumn("pace", A.trim_pace(F.col("pace"), F.col("lead_window")))
    if config.lags and with_features:
        # only stays that a lag can reach are read
        reached = F.col("stay_date").between(F.date_sub(first, max(config.lags)), F.date_add(first, longest))
        totals = confirmed.where(reached).groupBy(*pace.KEYS).agg(F.sum(value).alias("total"))
        matrix = matrix.join(features.lag_totals(totals, "total", config.lags), list(pace.KEYS), "left")
    if holidays is not None and with_features:
        matrix = features.with_calendar(matrix, hotels, holidays)
    return matrix


def repaired_paths(
    matrix: DataFrame, params: DataFrame, config: RunConfig, method: str = "pickup", unfitted: bool = False
) -> DataFrame:
    """Predicted, filled, repaired and (for rooms) capped paths, one row per hotel and stay; with `unfitted` also for
    stays at a distance without a model, their paths empty."""
    keep = ("available_rooms", "forecast_currency")
    lags = () if method == "pickup" else config.lags
    rows = features.inference_rows(matrix, lags, config.pace_features, keep)
    forecast = predict.pickup_predict if method == "pickup" else predict.linear_predict
    predicted = forecast(rows, params, config.quantiles, unfitted)
    return repair.repair_arrays(predicted, "available_rooms" if config.target_type == "ROOMS" else None)


def forecast(
    matrix: DataFrame,
    params: DataFrame,
    config: RunConfig,
    run_id: str,
    timestamp: datetime,
    method: str = "pickup",
    model_version: int | str = 1,
    strict: bool = False,
    unfitted: bool = False,
) -> DataFrame:
    """Published rows; a path that cannot be published is a failure row, or (strict) ends the job. With `unfitted` a
    stay at a distance without a model is such a path; else it has no row.

    Parameters that carry a version (operators.versions.pick) put each hotel's own on its rows.
    """
    paths = repaired_paths(matrix, params, config, method, unfitted)
    if "version" in params.columns:
        used = params.groupBy("HotelID").agg(F.max("version").alias("version"))
        paths, model_version = paths.join(used, "HotelID"), "version"
    return results.forecast_rows(
        paths, config.target_type, run_id, timestamp, method, model_version, config.without_pms, strict
    )


def publish(
    forecasts: DataFrame,
    requested: DataFrame,
    config: RunConfig,
    run_id: str,
    target: str,
    staging: str | None = None,
    counters: Observation | None = None,
) -> DataFrame:
    """Stage the forecasts, add failure rows, append the complete ones; returns the staged rows with failures.

    A repeated call with the same run_id appends only what the target does not hold yet of that run.
    `counters` are filled while the forecasts are staged (results.counted); results.run_report makes a table of them.
    """
    if counters is not None:
        forecasts = results.counted(forecasts, counters)
    staged = results.one_failure_each(sinks.stage(forecasts, staging))
    everything = staged.unionByName(results.failure_rows(requested, staged, run_id, NO_DATA, config.without_pms))
    done = results.completed(everything, config.target_type)
    earlier = sinks.existing(done.sparkSession, target)
    if earlier is not None:
        path = ["run_id", "HotelID", "stay_date", "day_index"]
        done = done.join(earlier.where(F.col("run_id") == run_id).select(*path), path, "left_anti")
    sinks.append(done, target)
    return everything
