import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pacecast.config import FarFieldConfig, RunConfig
from pacecast.functions import arrays as A
from pacecast.operators import features, pace
from pacecast.plans import training
from tests import data as D

CONFIG = RunConfig(horizon=6, snapshots=6, lead_window=12, lags=())


def brute_slot(rows, cancels, k, lead):
    """Amount booked at least `lead` days before and not cancelled by snapshot k."""
    total = 0.0
    for t, _, stay, booked, _, amount in rows:
        gone = (stay - cancels[t]).days if t in cancels else -1
        if booked >= lead and (k is None and gone == -1 or k is not None and gone < k):
            total += amount
    return total


@pytest.fixture(scope="module")
def case(spark):
    rnd = random.Random(7)
    rows, cancels, t = [], {}, 0
    for hotel in "AB":
        for offset in range(4):
            for _ in range(rnd.randint(1, 9)):
                t += 1
                lead = rnd.randint(0, 20)
                cancelled = rnd.random() < 0.4
                stay = D.STAY + timedelta(days=offset)
                if cancelled:
                    cancels[t] = stay - timedelta(days=rnd.randint(0, lead))
                rows.append((t, hotel, stay, lead, "Cancelled" if cancelled else "Confirmed", rnd.randint(1, 50)))
    args = D.bookings(spark, rows), D.transactions(spark, list(cancels.items())), D.statuses(spark)
    return rows, cancels, args


def of_stay(rows, hotel, stay):
    return [r for r in rows if r[1] == hotel and r[2] == stay]


def test_pace_and_snapshots_against_brute_force(case):
    rows, cancels, args = case
    aware = training.aware_bookings(*args, CONFIG)
    found = pace.snapshot_pace(aware, "revenue", 12, 6).collect()
    assert len(found) == 6 * len({(r[1], r[2]) for r in rows})
    for r in found:
        mine = of_stay(rows, r.HotelID, r.stay_date)
        assert r.pace == [brute_slot(mine, cancels, r.forecast_index, lead) for lead in range(12)]
    confirmed = training.confirmed_bookings(*args, CONFIG)
    for r in pace.target_pace(confirmed, "revenue", 6).collect():
        mine = of_stay(rows, r.HotelID, r.stay_date)
        assert r.target == [brute_slot(mine, cancels, None, lead) for lead in range(6)]


def test_one_scan_matrix_equals_join_of_two(case):
    _, _, args = case
    aware, confirmed = training.aware_bookings(*args, CONFIG), training.confirmed_bookings(*args, CONFIG)
    joined = pace.join_targets(
        pace.target_pace(confirmed, "revenue", 6), pace.snapshot_pace(aware, "revenue", 12, 6)
    )
    matrix = training.training_matrix(training.stays_from(aware, CONFIG), CONFIG)
    columns = ("HotelID", "stay_date", "forecast_index", "target", "pace")
    assert D.rows_of(matrix, *columns) == D.rows_of(joined, *columns)


def test_pace_properties(case):
    _, _, args = case
    matrix = training.training_matrix(training.stays_from(training.aware_bookings(*args, CONFIG), CONFIG), CONFIG)
    for r in matrix.collect():
        assert all(a >= b for a, b in zip(r.pace, r.pace[1:])), "pace rises with lead"
        assert all(p >= t for p, t in zip(r.pace, r.target)), "snapshot holds less than confirmed pace"


def test_rows_from_cells_equal_rows_from_matrix(case):
    _, _, args = case
    stays = training.stays_from(training.aware_bookings(*args, CONFIG), CONFIG)
    lagged = stays.join(features.lag_totals(stays, "total", (1, 2, 4)), list(pace.KEYS), "left")
    for n_pace in (None, 3):
        direct = features.rows_from_cells(lagged, range(1, 7), 12, (1, 2, 4), n_pace)
        stored = features.near_field_rows(training.training_matrix(lagged, CONFIG), 6, (1, 2, 4), n_pace)
        columns = ("HotelID", "stay_date", "day_ahead", "y", "base", "x")
        assert D.rows_of(direct, *columns) == D.rows_of(stored, *columns)


def test_near_field_sees_only_longer_lags_and_farther_leads(case):
    rows, cancels, args = case
    stays = training.stays_from(training.aware_bookings(*args, CONFIG), CONFIG)
    lagged = stays.join(features.lag_totals(stays, "total", (1, 2, 4)), list(pace.KEYS), "left")
    for r in features.near_field_rows(training.training_matrix(lagged, CONFIG), 6, (1, 2, 4)).collect():
        d, mine = r.day_ahead, of_stay(rows, r.HotelID, r.stay_date)
        assert len(r.y) == d and r.y[-1] == brute_slot(mine, cancels, None, 0)
        assert r.x[: 12 - d] == [brute_slot(mine, cancels, d - 1, lead) for lead in range(d, 12)]
        assert len(r.x) == 12 - d + sum(n > d for n in (1, 2, 4))


def test_far_field_rows(case):
    rows, cancels, args = case
    config = FarFieldConfig(points=(9, 7), step=3, lead_window=15, snapshots=10, lags=())
    stays = training.stays_from(training.aware_bookings(*args, config), config)
    stored = features.far_field_rows(pace.explode_snapshots(stays, 15, 10), config.points, 3)
    columns = ("HotelID", "stay_date", "day_ahead", "y", "base", "x")
    assert D.rows_of(training.model_rows(stays, config), *columns) == D.rows_of(stored, *columns)
    for r in stored.collect():
        mine = of_stay(rows, r.HotelID, r.stay_date)
        assert r.y == [brute_slot(mine, cancels, None, r.day_ahead - 3)]
        assert r.x == [brute_slot(mine, cancels, r.day_ahead, lead) for lead in range(r.day_ahead, 15)]


def test_nothing_after_the_origin_changes_features(spark, case):
    """Bookings made, and cancellations known, after the origin may change at will (snapshot offset 0)."""
    rows, cancels, args = case
    d = 4
    later = [r if r[3] >= d else (*r[:5], r[5] * 17 + 3) for r in rows]
    moved = {}
    for t, _, stay, lead, _, _ in rows:
        if t in cancels:
            gone = (stay - cancels[t]).days
            moved[t] = cancels[t] if gone >= d else stay
    other = D.bookings(spark, later), D.transactions(spark, list(moved.items())), D.statuses(spark)

    def picked(a):
        stays = training.stays_from(training.aware_bookings(*a, CONFIG), CONFIG)
        return D.rows_of(features.rows_from_cells(stays, [d], 12, snapshot_offset=0), "HotelID", "stay_date", "base", "x")

    assert picked(args) == picked(other)


def test_lags_by_calendar_day(spark):
    totals = spark.createDataFrame(
        [("A", D.day(0), 10.0), ("A", D.day(1), 7.0), ("A", D.day(7), 5.0), ("B", D.day(1), 99.0)],
        "HotelID string, stay_date date, total double",
    )
    lags = {(r.HotelID, r.stay_date): r for r in features.lag_totals(totals, "total", (1, 7)).collect()}
    assert lags["A", D.STAY].lag1 == 7.0 and lags["A", D.STAY].lag7 == 5.0
    assert lags["B", D.STAY].lag1 == 99.0 and lags["B", D.STAY].lag7 is None


def test_trim_widen_and_adr(spark):
    b = D.bookings(spark, [(1, "A", D.STAY, 2, "Confirmed", 30), (2, "A", D.STAY, 0, "Confirmed", 10)])
    curve = pace.pace(b, "revenue", 4)
    assert curve.first().pace == [40.0, 30.0, 30.0, 0.0]
    trimmed = pace.trim_to_hotel(curve.withColumn("lead_window", F.lit(2)))
    assert trimmed.first().pace == [40.0, 30.0, None, None]
    wide = pace.widen(curve.withColumn("target", F.slice("pace", 1, 2)), "RV", 3, 2, keep=("HotelID",))
    assert wide.columns == ["HotelID", "RV0_tgt", "RV1_tgt", "RV0", "RV1", "RV2"]
    assert tuple(wide.first()) == ("A", 40.0, 30.0, 40.0, 30.0, 30.0)
    assert pace.adr_pace(b, 4).first().pace == [20.0, 30.0, 30.0, None]


def test_calendar_features_on_known_days(spark):
    from datetime import date

    from pacecast.schema import HOLIDAYS, HOTELS

    hotels = spark.createDataFrame([("A", "a", "US", "NY"), ("D", "d", None, None)], HOTELS)
    off = spark.createDataFrame([(date(2020, 2, 29), "US", "NY", "leap")], HOLIDAYS)
    stays = spark.createDataFrame(
        [("A", date(2020, 2, 29)), ("A", date(2021, 1, 3)), ("D", date(2020, 2, 29))], "HotelID string, stay_date date"
    )
    got = {(r.HotelID, r.stay_date): r for r in features.with_calendar(stays, hotels, off).collect()}
    leap = got["A", date(2020, 2, 29)]
    assert (leap.day_of_year, leap.day_of_quarter, leap.week_of_quarter, leap.week_of_month) == (60, 60, 9, 5)
    assert (leap.holiday, leap.day_of_week_5, leap.month_of_quarter) == (1, 1, 2)
    sunday = got["A", date(2021, 1, 3)]
    assert (sunday.week_of_year, sunday.year, sunday.day_of_week_6, sunday.holiday) == (53, 2021, 1, 0)
    assert got["D", date(2020, 2, 29)].year is None
    table = features.hotel_calendar(
        features.region_calendar(hotels, date(2020, 2, 28), date(2021, 1, 3), off), hotels
    )
    same = {r.stay_date: r for r in table.where("HotelID = 'A'").collect()}
    assert same[date(2020, 2, 29)].week_of_quarter == 9 and table.where("HotelID = 'D'").isEmpty()


def test_running_total(spark):
    daily = spark.createDataFrame(
        [("A", D.STAY, D.day(5), 1.0), ("A", D.STAY, D.day(2), -3.0), ("A", D.STAY, D.day(0), 4.0)],
        "HotelID string, stay_date date, confirmation_date date, revenue double",
    )
    out = D.rows_of(pace.running_total(daily, "revenue"), "booking_lead", "cum_sum_value")
    assert out == [(0, 2.0), (2, -2.0), (5, 1.0)]


def test_fill_linear_and_running_max(spark):
    df = spark.createDataFrame(
        [([None, 1.0, None, None, 4.0, None],), ([None, None],), ([2.0, 1.0, 3.0],)], "p array<double>"
    )
    filled = [r[0] for r in df.select(A.fill_linear(F.col("p"))).collect()]
    assert filled == [[1.0, 1.0, 2.0, 3.0, 4.0, 4.0], [None, None], [2.0, 1.0, 3.0]]
    assert df.select(A.running_max(F.col("p"))).collect()[2][0] == [2.0, 2.0, 3.0]


@pytest.mark.parametrize("first,last", [(0, 7), (2, 5), (3, 3), (6, 9)])
def test_snapshots_in_one_fold_equal_each_by_itself(spark, first, last):
    """Every snapshot by definition: cells booked at least l days ahead and cancelled later than the snapshot, or never."""
    rnd = random.Random(first * 10 + last)
    rows = []
    for i in range(40):
        cells = [(rnd.randrange(12), rnd.choice([-1, -1, 0, 1, 2, 3, 4, 7]), float(rnd.randrange(1, 50))) for _ in range(i % 9)]
        rows.append((i, sorted(cells, reverse=True)))
    df = spark.createDataFrame(rows, "i int, cells array<struct<lead:int,gone:int,amount:double>>")
    held = pace.split_cells(df, 10)
    got = held.select("i", A.snapshots_between(F.col("lasting"), F.col("gone"), first, last).alias("all")).collect()
    for r in got:
        want = [
            [sum(a for lead, gone, a in rows[r["i"]][1] if lead >= slot and gone < k) for slot in range(10)]
            for k in range(first, last + 1)
        ]
        assert r["all"] == want
