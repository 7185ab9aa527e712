"""Model versions as a table: pick, promote, inventory. All by partial aggregates, no window over a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def model_name(target_type: str, model_type: str, without_pms: bool = False, prefix: str | None = None) -> Column:
    """Name of a hotel's model: [prefix_]hotel_target[_PMS]_type_model. Fixed format: version tables use it."""
    parts = [F.lit(prefix)] if prefix else []
    parts += [F.col("HotelID"), F.lit(target_type)] + ([] if without_pms else [F.lit("PMS")])
    return F.concat_ws("_", *parts, F.lit(model_type.upper()), F.lit("model"))


def latest_version(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """Newest version per model, or the newest tagged yes for a stage."""
    tagged = versions if stage is None else versions.where(F.col(f"stage_{stage}") == "yes")
    return tagged.groupBy("model_name").agg(F.max("version").alias("version"))


def require_version(wanted: DataFrame, versions: DataFrame, stage: str | None = None) -> DataFrame:
    """Picked version of each wanted model; a model without one fails the job."""
    picked = wanted.select("model_name").distinct().join(latest_version(versions, stage), "model_name", "left")
    text = F.concat(F.lit("no model version for "), F.col("model_name"))
    return picked.withColumn(
        "version", F.when(F.col("version").isNull(), F.raise_error(text).cast("int")).otherwise(F.col("version"))
    )


def named(params: DataFrame, version: int, target_type: str, model_type: str, without_pms: bool = False) -> DataFrame:
    """A parameter table as one version of its hotels' models; such tables are stacked by union."""
    return params.withColumns(
        {"model_name": model_name(target_type, model_type, without_pms), "version": F.lit(version)}
    )


def pick(params: DataFrame, versions: DataFrame, stage: str | None = None) -> DataFrame:
    """The rows of each model's newest version, or of the newest tagged yes for a stage."""
    return params.join(latest_version(versions, stage), ["model_name", "version"], "left_semi")


def unpicked(requested: DataFrame, picked: DataFrame) -> DataFrame:
    """Requested hotels whose model has no version to use."""
    return requested.join(picked.select("HotelID").distinct(), "HotelID", "left_anti")


def promote(versions: DataFrame, stage: str) -> DataFrame:
    """Only a model's newest yes keeps the stage; older yes tags turn to no."""
    tag = f"stage_{stage}"
    newest = versions.groupBy("model_name").agg(F.max(F.when(F.col(tag) == "yes", F.col("version"))).alias("_newest"))
    older = (F.col(tag) == "yes") & (F.col("version") < F.col("_newest"))
    return (
        versions.join(newest, "model_name", "inner")
        .withColumn(tag, F.when(older, F.lit("no")).otherwise(F.col(tag)))
        .drop("_newest")
    )


def inventory(latest: DataFrame, models: DataFrame, config: DataFrame) -> DataFrame:
    """Newest version of each hotel's model beside the hotel's settings; `models` maps model to hotel."""
    return latest.join(models, "model_name", "inner").join(config, "HotelID", "inner")
