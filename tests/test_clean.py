from datetime import date

import pytest
from pyspark.errors import PySparkException

from pacecast.config import RunConfig, evaluation_window
from pacecast.operators import clean, exclude
from pacecast.plans import training
from pacecast.schema import BOOKINGS, EXCLUSIONS, HOTELS, validate
from pacecast.sources import tables
from tests import data as D


@pytest.fixture()
def base(spark):
    rows = [
        (1, "A", D.STAY, 30, "Confirmed", 100),
        (2, "A", D.STAY, 20, "Confirmed", 50),  # has a cancellation date: anomaly
        (3, "A", D.STAY, 20, "Cancelled", 40),
        (4, "A", D.STAY, 20, "Cancelled", 30),  # cancelled after the stay: anomaly
        (5, "A", D.STAY, 20, "Cancelled", 20),  # no date: anomaly
        (6, "A", D.STAY, 10, "No-show", 10),
        (7, "A", D.STAY, 5, "Other", 5),
    ]
    seen = [(2, D.day(3)), (3, D.day(4)), (4, D.day(-2)), (9, D.day(1))]
    return D.bookings(spark, rows), D.transactions(spark, seen), D.statuses(spark)


def test_confirmed_and_cancel_aware(spark, base):
    aware = training.aware_bookings(*base, RunConfig())
    assert D.rows_of(aware, "TransactionID") == [(1,), (3,), (6,)]
    assert D.rows_of(training.confirmed_bookings(*base, RunConfig()), "TransactionID") == [(1,)]


def test_no_show_modes_differ_where_a_date_is_known(spark):
    b = D.bookings(spark, [(1, "A", D.STAY, 9, "No-show", 1), (2, "A", D.STAY, 9, "No-show", 1)])
    joined = clean.attach_cancellations(b, D.transactions(spark, [(1, D.day(5))]))
    kept = D.rows_of(clean.fill_no_show(joined, "fill_null"), "TransactionID", "cancellation_date")
    assert kept == [(1, D.day(5)), (2, D.STAY)]
    all_set = D.rows_of(clean.fill_no_show(joined, "overwrite"), "TransactionID", "cancellation_date")
    assert all_set == [(1, D.STAY), (2, D.STAY)]
    with pytest.raises(ValueError):
        clean.fill_no_show(joined, "other")


def test_cancellation_date_already_in_the_bookings(spark, base):
    dated = clean.attach_cancellations(base[0], base[1])
    a = training.aware_bookings(dated, None, base[2], RunConfig())
    assert D.rows_of(a, "TransactionID") == [(1,), (3,), (6,)]
    untouched = training.aware_bookings(dated, None, base[2], RunConfig(), no_show=None)
    assert D.rows_of(untouched, "TransactionID") == [(1,), (3,)]


def test_many_bookings_of_one_transaction_keep_their_rows(spark):
    b = D.bookings(spark, [(1, "A", D.STAY, i, "Cancelled", 1) for i in range(50)])
    joined = clean.attach_cancellations(b, D.transactions(spark, [(1, D.day(2)), (2, None)]))
    assert joined.count() == 50 and joined.where("cancellation_date is null").count() == 0


def test_preprocess_cuts(spark):
    b = D.bookings(
        spark,
        [
            (1, "A", date(2019, 1, 1), 3, "Confirmed", 1),
            (2, "A", date(2020, 3, 5), 3, "Confirmed", 1),
            (3, "A", date(2021, 9, 1), 3, "Confirmed", 1, "PMS"),
            (4, "A", date(2021, 9, 1), 3, "Confirmed", 1),
            (5, "A", date(2021, 9, 1), -1, "Confirmed", 1),
        ],
    )
    out = clean.preprocess(b, date(2020, 1, 1), True, (date(2020, 3, 1), date(2021, 8, 1)))
    assert D.rows_of(out, "TransactionID") == [(4,)]


def test_hotel_selection_and_validation(spark, base):
    hotels = spark.createDataFrame([("A", "a", "US", "NY"), ("B", "b", "GB", "LDN"), (None, "c", None, None)], HOTELS)
    assert clean.select_hotels(base[0], []).count() == 7
    assert clean.select_hotels(base[0], ["B"]).count() == 0
    tables.require_hotels(hotels.where("HotelID = 'A'"), hotels)
    with pytest.raises(ValueError, match="Z"):
        tables.require_hotels(spark.createDataFrame([("A",), ("Z",)], "HotelID string"), hotels)
    cleaned = tables.clean_hotels(hotels)
    assert D.rows_of(cleaned, "HotelID", "State") == [("A", "NY"), ("B", "N/A")]


def test_guards(spark, base):
    with pytest.raises(ValueError, match="empty"):
        tables.require_rows(base[0].where("false"), "bookings")
    with pytest.raises(ValueError, match="missing"):
        validate(base[0].drop("rooms"), BOOKINGS)
    with pytest.raises(ValueError, match="mistyped"):
        validate(base[0].withColumn("rooms", base[0].rooms.cast("int")), BOOKINGS)
    with pytest.raises(ValueError):
        RunConfig(target_type="OTHER")
    with pytest.raises(ValueError, match="0.5"):
        RunConfig(quantiles=(0.1, 0.9))


def test_missing_exclusion_table_excludes_nothing(spark, tmp_path):
    assert tables.read_exclusions(spark, str(tmp_path / "none")).count() == 0
    assert tables.read_exclusions(spark, "no_such_table").count() == 0


def test_exclusions_latest_and_inclusive(spark):
    listed = spark.createDataFrame(
        [
            ("A", "p", date(2020, 1, 1), date(2020, 3, 1), date(2020, 3, 30)),
            ("A", "p", date(2020, 2, 1), date(2020, 3, 10), date(2020, 3, 11)),
            ("A", "p", date(2020, 2, 1), date(2020, 3, 11), date(2020, 3, 12)),
            ("A", "q", date(2020, 9, 1), date(2020, 1, 1), date(2020, 12, 31)),
        ],
        EXCLUSIONS,
    )
    stays = spark.createDataFrame([("A", date(2020, 3, d)) for d in range(8, 15)] + [("B", date(2020, 3, 10))],
                                  "HotelID string, stay_date date")
    latest = exclude.latest_config(tables.exclusion_scan(listed, "p"))
    assert latest.count() == 2
    left = D.rows_of(exclude.drop_excluded(stays, latest), "HotelID", "stay_date")
    assert [d.day for h, d in left if h == "A"] == [8, 9, 13, 14] and ("B", date(2020, 3, 10)) in left


def test_date_parsing_raises_on_bad_text(spark):
    good = clean.parse_timestamp(spark.createDataFrame([("2020-03-31",)], "t string"), "t")
    assert good.first().t.year == 2020
    with pytest.raises(PySparkException):
        clean.parse_timestamp(spark.createDataFrame([("31.03.2020",)], "t string"), "t").collect()


def test_evaluation_window_ends_two_days_ago():
    assert evaluation_window(date(2020, 3, 31), 30) == (date(2020, 2, 28), date(2020, 3, 29))
