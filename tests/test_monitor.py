from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pacecast.config import RunConfig
from pacecast.functions.metrics import sape
from pacecast.operators import monitor
from pacecast.plans import backtest, monitoring
from tests import data as D


def forecasts(spark, paths, run=date(2020, 3, 28)):
    rows = [
        ("A", D.STAY, run, run + timedelta(days=i), False, i, float(v)) for i, v in enumerate(paths)
    ]
    return spark.createDataFrame(
        rows,
        "HotelID string, stay_date date, timestamp date, booking_date date, pms_sync_off boolean, day_index int, y_med double",
    )


def test_score_skips_origin_and_unknown_actuals(spark):
    b = D.bookings(spark, [(1, "A", D.STAY, 9, "Confirmed", 10), (2, "A", D.STAY, 2, "Confirmed", 30)])
    rows = monitor.score(forecasts(spark, [10, 20, 60, 70]), monitor.actuals(b, None, "revenue"), "REVENUE").collect()
    assert len(rows) == 1  # only two days before the stay was there a booking after the origin
    r = rows[0]
    assert (r.day_ahead_index, r.booking_index, r.y_true, r.y_pred) == (3, 1, 40.0, 20.0)
    assert r.SAPE == pytest.approx(2 * 20 / 60)


def test_sape_of_zeros(spark):
    df = spark.createDataFrame([(0.0, 0.0), (5.0, 0.0)], "y double, f double")
    assert [r[0] for r in df.select(sape(F.col("y"), F.col("f"))).collect()] == [0.0, 2.0]


def test_actuals_with_and_without_pms_differ(spark):
    b = D.bookings(
        spark,
        [(1, "A", D.STAY, 5, "Confirmed", 10, "PMS"), (2, "A", D.STAY, 3, "Confirmed", 7), (3, "A", D.STAY, 1, "Confirmed", 2, "PMS")],
    )
    got = D.rows_of(monitor.actuals(b, None, "revenue"), "pms_sync_off", "booking_lead", "y_true")
    assert got == [(False, 1, 19.0), (False, 3, 17.0), (False, 5, 10.0), (True, 3, 7.0)]
    for flag in (False, True):
        one = D.rows_of(monitor.actuals_one_flag(b, None, "revenue", flag), "pms_sync_off", "booking_lead", "y_true")
        assert one == [g for g in got if g[0] == flag]


def test_summary_bounds_keep_the_run_column(spark):
    b = D.bookings(spark, [(2, "A", D.STAY, 2, "Confirmed", 30)])
    f = forecasts(spark, [10, 20, 60, 70])
    rows = monitoring.summary({"REVENUE": f, "ROOMS": f}, b, date(2020, 1, 1), date(2020, 4, 1), F.lit(datetime(2020, 4, 2)))
    assert {"timestamp", "scored_at", "eval_start_date", "eval_end_date"} <= set(rows.columns)
    assert sorted(r.target_type for r in rows.collect()) == ["REVENUE", "ROOMS"]
    tri = monitoring.triangle(rows, date(2020, 1, 1), date(2020, 4, 1)).collect()
    assert {r.variable for r in tri} == {"SAPE"} and len(tri) == 2
    grid = monitor.triangle_grid(monitor.triangle(rows), 4)
    assert [c for c in grid.columns if c.startswith("d")] == ["d1", "d2", "d3", "d4"]


@pytest.fixture(scope="module")
def history(spark):
    rows, t = [], 0
    for offset in range(-40, 12):
        for lead in (0, 1, 3, 6):
            t += 1
            rows.append((t, "A", D.STAY + timedelta(days=offset), lead, "Confirmed", 10 + (offset * lead) % 7))
    return D.bookings(spark, rows)


CONFIG = RunConfig(horizon=5, snapshots=5, lead_window=8, lags=())


def test_origins_of_a_stay(spark):
    df = spark.createDataFrame([(date(2020, 1, d),) for d in (1, 2, 6, 9, 20)], "stay_date date")
    first, last = date(2020, 1, 1), date(2020, 1, 7)
    got = {
        r[0]: r[1]
        for r in df.select("stay_date", backtest.origins_of("stay_date", first, last, 2, 5)).collect()
    }
    for stay, origins in got.items():
        want = [o for o in backtest.origin_list(first, last, 2) if 1 <= (stay - o).days <= 5]
        assert origins == want


def test_backtest_of_one_origin_equals_its_part_of_many(history):
    first, last = D.STAY, D.STAY + timedelta(days=6)
    many = backtest.backtest(history, CONFIG, first, last, 3)
    columns = ("HotelID", "stay_date", "eval_start", "booking_index", "y_pred", "y_true")
    alone = backtest.backtest(history, CONFIG, first, first, 3)
    assert D.rows_of(many.where(F.col("eval_start") == F.lit(first)), *columns) == D.rows_of(alone, *columns)
    assert many.select("eval_start").distinct().count() == 3


def test_backtest_does_not_see_bookings_after_its_origin(spark, history):
    first = D.STAY
    changed = history.withColumn(
        "revenue", F.when(F.col("confirmation_date") > F.lit(first), F.col("revenue") * 13 + 1).otherwise(F.col("revenue"))
    )
    columns = ("stay_date", "booking_index", "y_pred")
    a = D.rows_of(backtest.backtest(history, CONFIG, first, first, 1), *columns)
    assert a == D.rows_of(backtest.backtest(changed, CONFIG, first, first, 1), *columns) and a


def test_path_metrics_first_points_only(spark):
    rows = [("A", D.STAY, D.day(3), D.day(0), i, float(p), float(t)) for i, (p, t) in enumerate([(1, 1), (2, 4), (0, 9)])]
    df = spark.createDataFrame(
        rows, "HotelID string, stay_date date, eval_start date, eval_end date, booking_index int, y_pred double, y_true double"
    )
    r = monitor.path_metrics(df, (1, 2)).first()
    assert (r.SMAPE1, r.MAE1) == (0.0, 0.0)
    assert (r.SMAPE2, r.MAE2) == (pytest.approx(2 * 2 / 6 / 2), 1.0)
