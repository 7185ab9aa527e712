"""Predictions: the parameter table joined to model rows, arithmetic on the JVM.

A hotel's parameters for one distance are gathered into one row in path order (at most `distance` of them), so
the join is one to one on (hotel, distance) and the path comes out as arrays. Distances without parameters, or
without a stay to forecast, drop out of the inner join; `missing_distances` reports them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacecast.functions import arrays as A
from pacecast.operators.fit import GROUP

RAW = ("y_lower_raw", "y_med_raw", "y_upper_raw")


def _slots(quantiles) -> tuple[int, int, int]:
    return 0, list(quantiles).index(0.5), len(quantiles) - 1


def _in_path_order(params: DataFrame, *values: str) -> DataFrame:
    item = F.struct((-F.col("target_lead")).alias("order"), F.col("target_lead"), *values)
    return params.groupBy(*GROUP).agg(F.array_sort(F.collect_list(item)).alias("_path"))


def _field(path: Column, name: str) -> Column:
    return F.transform(path, lambda point: point[name])


def _pickup(slot: int) -> Column:
    return F.transform("_path", lambda point: F.col("base") + point["offsets"][slot])


def _with_path(rows: DataFrame, paths: DataFrame, unfitted: bool) -> DataFrame:
    """Rows with their models in path order; with `unfitted` those without any keep their row and an empty path."""
    if not unfitted:
        return rows.join(paths, list(GROUP), "inner")
    empty = F.array().cast(paths.schema["_path"].dataType)
    return rows.join(paths, list(GROUP), "left").withColumn("_path", F.coalesce("_path", empty))


def pickup_predict(
    rows: DataFrame, params: DataFrame, quantiles=(0.1, 0.5, 0.9), unfitted: bool = False
) -> DataFrame:
    """Known pace plus the fitted pickup, for every point of the path."""
    slots = dict(zip(RAW, _slots(quantiles)))
    joined = _with_path(rows, _in_path_order(params, "offsets"), unfitted)
    return joined.withColumns(
        {
            "target_leads": _field(F.col("_path"), "target_lead"),
            **{name: _pickup(slot) for name, slot in slots.items()},
        }
    ).drop("_path")


def linear_predict(
    rows: DataFrame, params: DataFrame, quantiles=(0.1, 0.5, 0.9), unfitted: bool = False
) -> DataFrame:
    """Linear models walked along the path; every quantile of a point sees the medians of earlier points.

    For models that were not fitted recursively the path coefficients are empty and add nothing.
    """
    slots = dict(zip(RAW, _slots(quantiles)))
    joined = _with_path(rows, _in_path_order(params, "intercepts", "coefs", "path_coefs"), unfitted)

    def step(done, s):
        medians = F.transform(done, lambda p: p["y_med_raw"])

        def at(i):
            before = F.slice(medians, F.lit(1), F.size(s["path_coefs"][i]))
            return s["intercepts"][i] + A.dot(s["coefs"][i], F.col("x")) + A.dot(s["path_coefs"][i], before)

        return F.concat(done, F.array(F.struct(*[at(i).alias(n) for n, i in slots.items()])))

    empty = F.array().cast("array<struct<y_lower_raw:double,y_med_raw:double,y_upper_raw:double>>")
    walked = joined.withColumn("_walk", F.aggregate("_path", empty, step))
    return walked.withColumns(
        {
            "target_leads": _field(F.col("_path"), "target_lead"),
            **{name: _field(F.col("_walk"), name) for name in RAW},
        }
    ).drop("_path", "_walk")


def missing_distances(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Hotel distances that have a stay to forecast but no parameters."""
    return rows.select(*GROUP).distinct().join(params.select(*GROUP).distinct(), list(GROUP), "left_anti")
