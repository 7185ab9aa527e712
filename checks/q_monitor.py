"""Forecasts against actuals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.q_rows import confirmed
from checks.registry import check, r6, rounded
from pacecast.operators import monitor
from pacecast.plans import monitoring
from pacecast.sources.tables import forecast_scan

EVAL_START, EVAL_END = date(1995, 1, 1), date(2001, 8, 31)
RUN = "run_date"  # what tells the runs of the check views apart

ACTUALS_SQL = """
flagged as (select * from (select c.*, false as pms_sync_off from confirmed c union all
    select c.*, true from confirmed c where channel <> 'PMS') u where stay_date >= date '1995-01-01'),
daily as (select HotelID, stay_date, confirmation_date, pms_sync_off, sum(revenue) as revenue, sum(rooms) as rooms
  from flagged group by 1, 2, 3, 4),
actuals as (select HotelID, stay_date, confirmation_date, pms_sync_off,
  cast(stay_date - confirmation_date as int) as booking_lead,
  sum(revenue) over w as revenue, sum(rooms) over w as rooms from daily
  window w as (partition by HotelID, stay_date, pms_sync_off order by confirmation_date rows unbounded preceding))"""

SCORED_SQL = ACTUALS_SQL + """,
f as (select *, min(booking_date) over (partition by pms_sync_off, run_date, HotelID, stay_date) as origin, 'REVENUE' as target_type
    from forecasts union all by name
    select *, min(booking_date) over (partition by pms_sync_off, run_date, HotelID, stay_date) as origin, 'ROOMS' as target_type
    from room_forecasts),
scored as (select f.HotelID, f.stay_date, f.booking_date as confirmation_date, cast(f.stay_date - origin as int) as day_ahead_index,
    day_index as booking_index, y_med as y_pred, case when target_type = 'REVENUE' then revenue else rooms end as y_true,
    f.pms_sync_off, run_date, target_type
  from f join actuals a on a.HotelID = f.HotelID and a.stay_date = f.stay_date and a.confirmation_date = f.booking_date
    and a.pms_sync_off = f.pms_sync_off
  where booking_date > origin and f.stay_date >= date '1995-01-01'),
sapes as (select *, 2 * abs(y_true - y_pred) / (abs(y_true) + abs(y_pred)) as SAPE from scored
  where y_true is not null and y_true <> 0)"""


def scored(v):
    tables = {"REVENUE": v.forecasts, "ROOMS": v.room_forecasts}
    return monitoring.summary(tables, confirmed(v), EVAL_START, EVAL_END, F.lit("2001-09-02").cast("date"), RUN)


@check(
    "n01_u01_actuals",
    "confirmed",
    "with " + ACTUALS_SQL.strip() + """
       select HotelID, stay_date, confirmation_date, booking_lead, pms_sync_off, round(revenue, 6) + 0.0 as y_true,
         'REVENUE' as target_type from actuals
       union all select HotelID, stay_date, confirmation_date, booking_lead, pms_sync_off, round(rooms, 6) + 0.0, 'ROOMS'
       from actuals""",
)
def n01(v):
    return rounded(monitor.actuals_by_target(confirmed(v), EVAL_START, monitoring.VALUES), "y_true")


@check(
    "n01_actuals_without_pms",
    "confirmed",
    "with " + ACTUALS_SQL.strip() + """
       select HotelID, stay_date, confirmation_date, booking_lead, pms_sync_off, round(rooms, 6) + 0.0 as y_true
       from actuals where pms_sync_off""",
)
def n01_without(v):
    return rounded(monitor.actuals_one_flag(confirmed(v), EVAL_START, "rooms", True), "y_true")


@check(
    "n02_f22_align_forecasts",
    "forecasts",
    """select HotelID, stay_date, booking_date as confirmation_date, run_date, cast(stay_date - run_date as int) as day_ahead_index,
         day_index as booking_index, round(y_med, 6) + 0.0 as y_pred from forecasts where booking_date > run_date""",
)
def n02(v):
    aligned = monitor.align(v.forecasts, RUN)
    return rounded(
        aligned.select(
            "HotelID", "stay_date", "confirmation_date", "run_date", "day_ahead_index", "booking_index", "y_pred"
        ),
        "y_pred",
    )


@check(
    "a08_forecast_scan",
    "forecasts",
    """select HotelID, stay_date, booking_date, round(y_med, 6) + 0.0 as y_med from forecasts
       where stay_date >= date '2000-01-01'""",
)
def a08(v):
    window = forecast_scan(v.forecasts, date(2000, 1, 1))
    return rounded(window.select("HotelID", "stay_date", "booking_date", "y_med"), "y_med")


@check(
    "n03_j05_f21_sape",
    "confirmed forecasts room_forecasts",
    "with " + SCORED_SQL.strip() + """
       select HotelID, stay_date, confirmation_date, day_ahead_index, booking_index, round(y_pred, 6) + 0.0 as y_pred,
         round(y_true, 6) + 0.0 as y_true, pms_sync_off, run_date, round(SAPE, 6) + 0.0 as SAPE from sapes
       where target_type = 'REVENUE'""",
)
def n03(v):
    rows = monitor.score(v.forecasts, monitor.actuals(confirmed(v), EVAL_START, "revenue"), "REVENUE", RUN)
    return rounded(rows.drop("target_type"), "y_pred", "y_true", "SAPE")


@check(
    "n04_summary_rows",
    "confirmed forecasts room_forecasts",
    "with " + SCORED_SQL.strip() + f"""
       select HotelID, stay_date, confirmation_date, day_ahead_index, booking_index, round(y_pred, 6) + 0.0 as y_pred,
         round(y_true, 6) + 0.0 as y_true, pms_sync_off, run_date, round(SAPE, 6) + 0.0 as SAPE, target_type,
         date '{EVAL_START}' as eval_start_date, date '{EVAL_END}' as eval_end_date, date '2001-09-02' as scored_at
       from sapes""",
)
def n04(v):
    return rounded(scored(v), "y_pred", "y_true", "SAPE")


TRIANGLE_SQL = SCORED_SQL + """,
tri as (select pms_sync_off, target_type, HotelID, day_ahead_index, booking_index, avg(SAPE) as value
  from sapes group by 1, 2, 3, 4, 5)"""


@check(
    "n05_g07_r01_triangle",
    "confirmed forecasts room_forecasts",
    "with " + TRIANGLE_SQL.strip() + f"""
       select pms_sync_off, target_type, HotelID, day_ahead_index, booking_index, 'SAPE' as variable,
         round(value, 6) + 0.0 as value, date '{EVAL_START}' as eval_start_date, date '{EVAL_END}' as eval_end_date
       from tri""",
)
def n05(v):
    return rounded(monitoring.triangle(scored(v), EVAL_START, EVAL_END).drop("scored_at"), "value")


@check(
    "g12_metric_range",
    "confirmed forecasts room_forecasts",
    "with " + TRIANGLE_SQL.strip()
    + " select HotelID, round(min(value), 6) + 0.0 as value_min, round(max(value), 6) + 0.0 as value_max from tri group by 1",
)
def g12(v):
    return rounded(monitor.metric_range(monitor.triangle(scored(v))), "value_min", "value_max")


@check(
    "r02_triangle_grid",
    "confirmed forecasts",
    "with " + ACTUALS_SQL.strip() + """,
       g as (select f.HotelID, f.pms_sync_off, day_index as booking_index, cast(f.stay_date - f.booking_date as int) + 1 as ahead,
           avg(2 * abs(a.revenue - y_med) / (abs(a.revenue) + abs(y_med))) as value
         from forecasts f join actuals a on a.HotelID = f.HotelID and a.stay_date = f.stay_date
           and a.confirmation_date = f.booking_date and a.pms_sync_off = f.pms_sync_off
         where f.booking_date >= f.stay_date - 27 and a.revenue <> 0 group by 1, 2, 3, 4)
       select HotelID, pms_sync_off, 'REVENUE' as target_type, 'SAPE' as variable, booking_index, """
    + ", ".join(f"round(max(case when ahead = {d} then value end), 6) + 0.0 as d{d}" for d in range(1, 29))
    + " from g group by 1, 2, 5",
)
def r02(v):
    # runs of the view all start 28 days ahead; the distance of each point itself spreads the grid over its columns
    rows = monitor.score(v.forecasts, monitor.actuals(confirmed(v), EVAL_START, "revenue"), "REVENUE", RUN)
    ahead = F.datediff("stay_date", "confirmation_date") + 1
    grid = monitor.triangle_grid(monitor.triangle(rows.withColumn("day_ahead_index", ahead)), 28)
    days = [f"d{d}" for d in range(1, 29)]
    return grid.select(
        "HotelID", "pms_sync_off", "target_type", "variable", "booking_index", *[r6(d).alias(d) for d in days]
    )
