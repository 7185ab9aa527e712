"""Published forecasts against actuals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacecast.operators import monitor
from pacecast.sources.tables import forecast_scan


VALUES = {"REVENUE": "revenue", "ROOMS": "rooms"}


def summary(
    forecasts: dict[str, DataFrame],
    confirmed: DataFrame,
    eval_start: date,
    eval_end: date,
    scored_at: Column | None = None,
    run: str = monitor.RUN,
) -> DataFrame:
    """Error rows of all target types; `forecasts` maps REVENUE / ROOMS to its forecast table. The bookings are
    read, summed and joined once for all of them."""
    columns = ["HotelID", "stay_date", "booking_date", "pms_sync_off", "day_index", "y_med", run]
    tagged = [
        forecast_scan(table, eval_start).select(*columns, F.lit(target).alias("target_type"))
        for target, table in forecasts.items()
    ]
    actual = monitor.actuals_by_target(confirmed, eval_start, {t: VALUES[t] for t in forecasts})
    scored = monitor.score_targets(monitor.union_targets(*tagged), actual, run)
    return monitor.with_bounds(scored, eval_start, eval_end, scored_at)


def triangle(rows: DataFrame, eval_start: date, eval_end: date, scored_at: Column | None = None) -> DataFrame:
    return monitor.with_bounds(monitor.triangle(rows), eval_start, eval_end, scored_at)
