"""Bookings to training rows and parameters, as one lazy plan."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacecast.config import FarFieldConfig, RunConfig
from pacecast.functions import arrays as A
from pacecast.functions.metrics import target_column
from pacecast.operators import clean, exclude, features, fit, pace
from pacecast.sources import sinks
from pacecast.sources.tables import exclusion_scan


def _dated(bookings: DataFrame, transactions: DataFrame | None, config: RunConfig, no_show: str | None) -> DataFrame:
    """Bookings with their cancellation date, looked up or (transactions None) already in the table.

    Row-local cuts come first, so that less is shuffled to meet the transactions.
    """
    kept = clean.preprocess(bookings, config.model_start, config.without_pms)
    if transactions is not None and config.filter_bits:
        kept = clean.attach_to_candidates(kept, transactions, config.filter_bits)
    elif transactions is not None:
        kept = clean.attach_cancellations(kept, transactions)
    return clean.fill_no_show(kept, no_show)


def aware_bookings(
    bookings: DataFrame,
    transactions: DataFrame | None,
    lookup: DataFrame,
    config: RunConfig,
    no_show: str | None = "fill_null",
) -> DataFrame:
    """Rows that features count; with config.targets_by_status also those that targets alone count, so marked."""
    dated = _dated(bookings, transactions, config, no_show)
    return (clean.with_status_targets if config.targets_by_status else clean.cancel_aware)(dated, lookup)


def confirmed_bookings(
    bookings: DataFrame,
    transactions: DataFrame | None,
    lookup: DataFrame,
    config: RunConfig,
    no_show: str | None = "fill_null",
) -> DataFrame:
    return clean.confirmed_only(_dated(bookings, transactions, config, no_show), lookup)


def stays_from(aware: DataFrame, config: RunConfig, tasks: int | None = None) -> DataFrame:
    """Cells, targets and final total per hotel and stay, from one scan.

    Confirmed-only bookings are exactly the never-cancelled cells, so targets and cancel-aware features share
    their cells instead of scanning twice and joining. Stays without a confirmed booking have no target and go.
    Target-only cells leave once the targets are known; a stay without others has no features and goes as well.
    """
    cells = pace.stay_cells(aware, target_column(config.target_type), config.lead_window, config.snapshots, tasks)
    confirmed = A.confirmed_cells(F.col("cells"))
    seen = A.seen_cells(F.col("cells")) if config.targets_by_status else F.col("cells")
    return cells.where((F.size(confirmed) > 0) & (F.size(seen) > 0)).select(
        *pace.KEYS,
        seen.alias("cells"),
        A.pace_between(confirmed, 0, config.targets).alias("target"),
        A.booked_at(confirmed, 0).alias("total"),
    )


def training_stays(
    bookings: DataFrame,
    transactions: DataFrame | None,
    lookup: DataFrame,
    config: RunConfig,
    hotels: DataFrame | None = None,
    holidays: DataFrame | None = None,
    exclusions: DataFrame | None = None,
    partition_date: date | Column | None = None,
    with_features: bool = True,
    requested: DataFrame | list[str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """One compact row per hotel and stay: cells, targets, lags, calendar, excluded ranges taken out.

    `exclusions` is the table as it is: entries of config.pipeline count, the newest of each hotel. `requested`
    names the hotels to train; without it all are. `tasks` sets the number of partitions of the main exchange.

    Everything joins on (hotel, stay) here; snapshots are exploded later from the compact row. The pickup fit
    reads no lags or calendar: without `with_features` their joins are not made.
    """
    cut = partition_date or config.partition_date or clean.watermark(bookings)
    bookings = clean.select_hotels(bookings, requested)
    # lags look back, so the cut may come first: both uses below then share one shuffle of the bookings
    kept = aware_bookings if config.cancel_aware else confirmed_bookings
    stays = clean.train_cut(stays_from(kept(bookings, transactions, lookup, config), config, tasks), cut)
    out = stays
    if config.lags and with_features:
        out = out.join(features.lag_totals(stays.select(*pace.KEYS, "total"), "total", config.lags), list(pace.KEYS), "left")
    if hotels is not None and "lead_window" in hotels.columns:
        out = out.join(hotels.select("HotelID", "lead_window"), "HotelID", "left")
    if hotels is not None and holidays is not None and with_features:
        out = features.with_calendar(out, hotels, holidays)
    if exclusions is not None:
        own = exclusion_scan(exclusions, config.pipeline)
        out = exclude.drop_excluded(out, exclude.latest_config(own))
    return out


def training_matrix(stays: DataFrame, config: RunConfig) -> DataFrame:
    """One row per hotel, stay and snapshot, with pace, targets, lags and calendar."""
    return pace.explode_snapshots(stays, config.lead_window, config.snapshots)


def write_matrix(stays: DataFrame, config: RunConfig, target: str) -> None:
    """Rebalance the compact rows by hotel, explode after it: the wide rows are written where they arise."""
    sinks.overwrite(training_matrix(sinks.rebalance(stays, "HotelID"), config), target, spread=False)


def model_rows(stays: DataFrame, config: RunConfig, distances: Column | None = None, keep=()) -> DataFrame:
    far = isinstance(config, FarFieldConfig)
    return features.rows_from_cells(
        stays,
        config.distances if distances is None else distances,
        config.lead_window,
        config.lags,
        config.pace_features,
        snapshot_offset=0 if far else 1,
        far_step=config.step if far else None,
        keep=keep,
    )


def placed_rows(stays: DataFrame, config: RunConfig, parts: int = 4, tasks: int | None = None) -> DataFrame:
    """Model rows with their features worked out after the shuffle.

    Compact stays are copied once per part and placed by (hotel, part); a part explodes only its share of the
    distances. So `parts` compact rows a stay travel, not a feature vector for every distance, and a hotel
    still spreads over `parts` tasks.
    """
    copied = stays.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    placed = copied.repartition(tasks or pace.work_tasks(stays.sparkSession), "part", "HotelID")
    numbered = F.lit(list(config.distances))
    share = F.filter(numbered, lambda _, i: i % parts == F.col("part"))
    return model_rows(placed, config, share, keep=("part",))


def train(stays: DataFrame, config: RunConfig, method: str = "pickup") -> DataFrame:
    """Parameter table of one method, near or far field by the kind of config."""
    far_step = config.step if isinstance(config, FarFieldConfig) else None
    if method == "pickup":
        return fit.pickup_fit(model_rows(stays, replace(config, lags=())), config.quantiles, far_step)
    return fit.linear_fit(placed_rows(stays, config), config.quantiles, far_step, config.recursive)


def holdout(stays: DataFrame, config: RunConfig, lengths: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Split by the last `horizon` days per hotel, or its own training length; a test stay is read at its own
    distance from the cut."""
    split = features.horizon_split(stays, config.horizon, lengths)
    return (
        split.where(~F.col("is_test")).drop("test_start", "test_end", "is_test"),
        split.where(F.col("is_test")).drop("test_end", "is_test"),
    )


def holdout_model_rows(test: DataFrame, config: RunConfig) -> DataFrame:
    """Test rows at the distance between stay and cut; the cut day itself has no distance and drops out."""
    distance = F.datediff("stay_date", "test_start")
    own = F.when(distance.between(1, config.horizon), F.array(distance)).otherwise(F.array().cast("array<int>"))
    return model_rows(test, config, own)
