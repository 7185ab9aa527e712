"""Far-field hold-out: nine weekly points, fitted before the last 91 days and checked once each."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacecast.config import FarFieldConfig
from pacecast.operators import features, predict, results
from pacecast.plans import training


def holdout_points(stays: DataFrame, config: FarFieldConfig) -> DataFrame:
    """The one stay date each point is checked on: start of the test part + point."""
    ends = stays.groupBy("HotelID").agg(F.max("stay_date").alias("test_end"))
    return ends.select(
        "HotelID", F.date_sub("test_end", max(config.points)).alias("test_start"), F.explode(F.lit(list(config.points))).alias("day_ahead")
    ).select("HotelID", "day_ahead", F.date_add("test_start", F.col("day_ahead")).alias("stay_date"))


def evaluate(stays: DataFrame, config: FarFieldConfig, method: str = "pickup") -> DataFrame:
    """Train on stays before the test part, predict each point's stay; absent stays read zeros."""
    split = features.horizon_split(stays, max(config.points))
    train, test = (split.where(c).drop("test_end", "is_test") for c in ("not is_test", "is_test"))
    params = training.train(train.drop("test_start"), config, method)
    wanted = holdout_points(stays, config)
    # each test stay is the one that at most one point is checked on
    own = F.filter(F.lit(list(config.points)), lambda p: F.date_add("test_start", p) == F.col("stay_date"))
    rows = training.model_rows(test, replace(config, lags=()) if method == "pickup" else config, own)
    forecast = predict.pickup_predict if method == "pickup" else predict.linear_predict
    return results.far_field_results(wanted, forecast(rows, params, config.quantiles))
