"""Result tables: forecast rows, failure rows, hold-out and far-field rows, run summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pacecast.config import SENTINEL_DATE
from pacecast.operators.repair import NO_ROOMS
from pacecast.operators.versions import model_name
from pacecast.schema import FORECAST

PATHS = ("y_med", "y_upper", "y_lower", "y_med_raw", "y_upper_raw", "y_lower_raw")


def explode_path(df: DataFrame, *paths: str, keep=("HotelID", "stay_date", "day_ahead")) -> DataFrame:
    """Arrays to long rows with the place on the path and the lead it stands for."""
    zipped = F.arrays_zip("target_leads", *paths)
    # outer, with empty paths dropped after it: a plain explode would add a check that works the arrays out twice
    long = df.select(*keep, F.posexplode_outer(zipped).alias("booking_index", "_p"))
    return long.where(F.col("booking_index").isNotNull()).select(
        *keep, "booking_index", F.col("_p.target_leads").alias("target_lead"), *[F.col(f"_p.{p}").alias(p) for p in paths]
    )


def _with_origin(df: DataFrame) -> DataFrame:
    """Put the known pace in front of every path, as point 0 on the origin date (own rule)."""
    known = {p: F.concat(F.array("base"), F.col(p)) for p in PATHS}
    return df.withColumns({"target_leads": F.concat(F.array("day_ahead"), F.col("target_leads")), **known})


# What readers of the results look for.
DONE, FAILED, DONE_TEXT = "complete", "incomplete", "Successfully processed "
NO_CURRENCY = "forecast currency is missing for a revenue forecast"
NO_PATH = "no point of the path could be predicted"
NO_MODEL = "no model for the distance"


def path_failure(df: DataFrame, target_type: str) -> Column:
    """Why a path cannot be published, or null. A failing path never fails the others."""
    predicted = F.coalesce(F.exists("y_med_raw", lambda y: y.isNotNull()), F.lit(False))
    why = F.when(F.size("target_leads") == 0, NO_MODEL).when(~predicted, NO_PATH)
    if target_type == "REVENUE":
        return F.when(F.col("forecast_currency").isNull(), NO_CURRENCY).otherwise(why)
    if target_type == "ROOMS" and "available_rooms" in df.columns:
        return F.when(F.col("available_rooms").isNull(), NO_ROOMS).otherwise(why)
    return why


def _sentinel(run_id: str, pms_sync_off: bool) -> dict[str, Column]:
    """The columns of a failure row, but for its hotel, currency and message."""
    return {
        "run_id": F.lit(run_id),
        "stay_date": F.lit(SENTINEL_DATE),
        "booking_date": F.lit(SENTINEL_DATE),
        "model_version": F.lit(0),
        "timestamp": F.lit(datetime(1900, 1, 1)),
        "pms_sync_off": F.lit(pms_sync_off),
        "day_index": F.lit(0),
        "model_name": F.lit(""),
        "status": F.lit(FAILED),
        **{p: F.lit(0.0) for p in PATHS},
    }


def forecast_rows(
    repaired: DataFrame,
    target_type: str,
    run_id: str,
    timestamp: datetime,
    model_type: str = "pickup",
    model_version: int | str = 1,
    pms_sync_off: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Repaired paths to the published 18 columns. Needs `forecast_currency` on the rows; `model_version` is one
    number for all, or the column that holds each hotel's.

    A path that cannot be published (path_failure) becomes one sentinel row with its reason; `one_failure_each`
    leaves one such row a hotel and reason. With `strict` the first such path ends the job instead.
    """
    why = path_failure(repaired, target_type)
    if strict:
        why = F.when(why.isNotNull(), F.raise_error(why).cast("string"))
    marked = _with_origin(repaired.withColumn("_why", why))
    failed_path = F.col("_why").isNotNull()
    short = {c: F.when(failed_path, F.slice(c, 1, 1)).otherwise(F.col(c)) for c in ("target_leads", *PATHS)}
    by_hotel = [model_version] if isinstance(model_version, str) else []
    keep = ("HotelID", "stay_date", "day_ahead", "forecast_currency", "_why", *by_hotel)
    long = explode_path(marked.withColumns(short), *PATHS, keep=keep)
    named = long.withColumns(
        {
            "run_id": F.lit(run_id),
            "booking_date": F.date_sub("stay_date", F.col("target_lead")),
            "model_version": F.col(model_version) if by_hotel else F.lit(model_version),
            "timestamp": F.lit(timestamp),
            "pms_sync_off": F.lit(pms_sync_off),
            "day_index": F.col("booking_index"),
            "model_name": model_name(target_type, model_type, pms_sync_off),
            "status": F.lit(DONE),
            "message": F.concat(F.lit(DONE_TEXT), F.col("HotelID")),
        }
    )
    fixed = {c: F.when(failed_path, v).otherwise(F.col(c)) for c, v in _sentinel(run_id, pms_sync_off).items()}
    fixed["message"] = F.coalesce("_why", "message")
    return named.withColumns(fixed).select(*FORECAST.fieldNames())


def one_failure_each(rows: DataFrame) -> DataFrame:
    """Forecast rows with one failure row a hotel and reason. Reads `rows` twice: stage them first."""
    return rows.where(F.col("status") == DONE).unionByName(rows.where(F.col("status") != DONE).distinct())


def failure_rows(
    requested: DataFrame, done: DataFrame, run_id: str, message: str, pms_sync_off: bool = False
) -> DataFrame:
    """One sentinel row for each requested hotel that has no result. `done` is read again: stage it first."""
    lost = requested.join(done.select("HotelID").distinct(), "HotelID", "left_anti")
    currency = F.col("forecast_currency") if "forecast_currency" in requested.columns else F.lit(None).cast("string")
    fixed = {**_sentinel(run_id, pms_sync_off), "forecast_currency": currency, "message": F.lit(message)}
    return lost.withColumns(fixed).select(*FORECAST.fieldNames())


def training_run(
    requested: DataFrame,
    params: DataFrame,
    target_type: str,
    run_id: str,
    timestamp: datetime,
    model_type: str = "pickup",
    model_version: int = 1,
    pms_sync_off: bool = False,
    message: str = "No training rows",
) -> DataFrame:
    """One row per requested hotel: fitted, or not with the reason."""
    fitted = params.select("HotelID").distinct().withColumn("_fitted", F.lit(True))
    hotels = requested.select("HotelID").distinct().join(fitted, "HotelID", "left")
    ok = F.col("_fitted").isNotNull()
    return hotels.select(
        "HotelID",
        F.lit(run_id).alias("run_id"),
        F.lit(model_version).alias("model_version"),
        F.when(ok, F.lit(timestamp)).otherwise(F.lit(datetime(1900, 1, 1))).alias("timestamp"),
        F.lit(pms_sync_off).alias("pms_sync_off"),
        model_name(target_type, model_type, pms_sync_off).alias("model_name"),
        F.when(ok, "complete").otherwise("incomplete").alias("status"),
        F.when(ok, F.concat(F.lit("Successfully trained "), F.col("HotelID"))).otherwise(message).alias("message"),
    )


def completed(results: DataFrame, target_type: str) -> DataFrame:
    """Rows to publish: complete ones, without job columns; room forecasts carry no currency."""
    kept = results.where(F.col("status") == "complete").drop("status", "message")
    return kept.drop("forecast_currency") if target_type == "ROOMS" else kept


def failed(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") != "complete")


def run_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_distinct(F.when(F.col("status") == "complete", F.col("HotelID"))).alias("hotels_completed"),
        F.count_distinct("HotelID").alias("hotels_total"),
    )


#: The report's lines, in the order of the counters.
REASONS = (DONE, NO_MODEL, NO_CURRENCY, NO_ROOMS, NO_PATH)


def counted(rows: DataFrame, counters: Observation) -> DataFrame:
    """Forecast rows that count their paths, complete and by reason, while something else writes them.

    Take it before `one_failure_each`: there each failing path still has a row of its own.
    """
    first = F.col("day_index") == 0
    complete, failing = first & (F.col("status") == DONE), F.col("status") != DONE
    per_reason = [complete if r == DONE else failing & (F.col("message") == r) for r in REASONS]
    return rows.observe(counters, *[F.count_if(c).alias(f"n{i}") for i, c in enumerate(per_reason)])


def run_report(spark: SparkSession, counters: Observation) -> DataFrame:
    """Paths of a run by outcome, from the counters of its write: no further pass over the rows."""
    seen = counters.get
    rows = [(reason, int(seen.get(f"n{i}", 0))) for i, reason in enumerate(REASONS)]
    return spark.createDataFrame(rows, "outcome string, paths long")


def holdout_rows(predicted: DataFrame, pms_sync_off: bool = False) -> DataFrame:
    """Hold-out predictions beside the truth; `predicted` carries the targets as `y`."""
    long = explode_path(predicted, "y_med_raw", "y", keep=("HotelID", "stay_date"))
    return long.select(
        "HotelID",
        F.lit(pms_sync_off).alias("pms_sync_off"),
        F.lit("complete").alias("status"),
        F.concat(F.lit("Successfully trained "), F.col("HotelID")).alias("message"),
        "stay_date",
        F.col("y_med_raw").alias("y_pred"),
        F.col("y").alias("y_true"),
        "booking_index",
    )


def far_field_results(expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row per hotel and far point; a point whose stay is absent reads zeros.

    `expected` holds HotelID, day_ahead and stay_date of every point asked for.
    """
    long = explode_path(predicted, "y", "y_med_raw", "y_lower_raw", "y_upper_raw")
    names = {"y": "y_true", "y_med_raw": "y_pred", "y_lower_raw": "y_lower", "y_upper_raw": "y_upper"}
    keys = ["HotelID", "day_ahead", "stay_date"]
    joined = expected.join(long, keys, "left")
    return joined.select(
        "HotelID",
        "stay_date",
        F.col("day_ahead").alias("prediction_point"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(n) for c, n in names.items()],
    )
