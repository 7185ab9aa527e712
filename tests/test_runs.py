"""Kept cells, the watermark from footers, merged exclusion ranges, the run report."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks import q_forecast, q_rows, q_runs
from checks.registry import Inputs
from pacecast.operators import exclude, kept, predict, results
from pacecast.plans import inference
from pacecast.sources import tables
from tests import data as D
from tests.test_fit import CONFIG, hotel, plan  # noqa: F401

DAYS = [date(2020, 3, 1) + timedelta(days=i) for i in range(40)]
AWARE = "HotelID string, stay_date date, confirmation_date date, cancellation_date date, revenue double, rooms double"


def random_aware(n, seed):
    rnd, rows = random.Random(seed), []
    for _ in range(n):
        made, stay = sorted(rnd.sample(range(40), 2))
        gone = rnd.choice([None, None, DAYS[rnd.randrange(0, stay + 1)]])
        rows.append((rnd.choice("AB"), DAYS[stay], DAYS[made], gone, float(rnd.randrange(1, 9)), 1.0))
    return rows


def cells_by_hand(rows, through):
    out = {}
    for h, stay, made, gone, revenue, rooms in rows:
        if made > through:
            continue
        known = gone is not None and max(gone, made) <= through
        key = (h, stay, (stay - made).days, (stay - gone).days if known else -1)
        n, r, k = out.get(key, (0, 0.0, 0.0))
        out[key] = (n + 1, r + revenue, k + rooms)
    return sorted((*k, *v) for k, v in out.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_kept_cells_follow_each_day(spark, tmp_path, seed):
    rows = random_aware(300, seed)
    aware = spark.createDataFrame([*rows, (None, DAYS[3], DAYS[1], None, 5.0, 1.0), ("A", None, DAYS[1], None, 5.0, 1.0)], AWARE)
    path, after = str(tmp_path / "kept"), None
    for through in (DAYS[20], DAYS[21], DAYS[22], DAYS[39]):
        kept.record(kept.changes(aware, after, through), path, through)
        after = through
    kept.record(kept.changes(aware, DAYS[20], DAYS[21]), path, DAYS[21])  # a repeated day changes nothing
    columns = (*kept.CELL, *kept.AMOUNTS)
    for through in (DAYS[20], DAYS[21], DAYS[22], DAYS[39]):
        assert D.rows_of(kept.state(spark, path, through), *columns) == cells_by_hand(rows, through)
    merged = str(tmp_path / "merged")
    kept.compact(spark, path, DAYS[22], merged)
    assert D.rows_of(kept.state(spark, merged), *columns) == cells_by_hand(rows, DAYS[39])
    assert spark.read.parquet(merged).select("through").distinct().count() == 2


def test_kept_cells_of_no_bookings(spark, tmp_path):
    empty, path = spark.createDataFrame([], AWARE), str(tmp_path / "kept")
    some = spark.createDataFrame(random_aware(20, 3), AWARE)
    kept.record(kept.changes(some, None, DAYS[39]), path, DAYS[39])
    kept.record(kept.changes(empty, DAYS[39], DAYS[39] + timedelta(days=1)), path, DAYS[39] + timedelta(days=1))
    assert kept.state(spark, path).agg(F.sum("n")).first()[0] == 20


def test_watermark_reads_no_column(spark, tmp_path):
    path = str(tmp_path / "bookings")
    spark.createDataFrame(random_aware(50, 4), AWARE).repartition(3).write.parquet(path)
    want = spark.read.parquet(path).agg(F.max("confirmation_date")).first()[0]
    assert tables.footer_watermark(spark, path) == want
    asking = spark.newSession()
    for key, value in tables.FOOTER_SETTINGS.items():
        asking.conf.set(key, value)
    explained = tables.latest_in(asking, path, "confirmation_date")._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(confirmation_date)]" in explained
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


def test_watermark_without_statistics_or_rows(spark, tmp_path):
    bare, none = str(tmp_path / "bare"), str(tmp_path / "none")
    rows = spark.createDataFrame(random_aware(50, 5), AWARE)
    rows.write.option("parquet.column.statistics.enabled", "false").parquet(bare)
    rows.where("false").write.parquet(none)
    assert tables.footer_watermark(spark, bare) == rows.agg(F.max("confirmation_date")).first()[0]
    assert tables.footer_watermark(spark, none) is None


def test_ten_thousand_ranges_of_one_hotel(spark):
    rnd, start = random.Random(6), date(2000, 1, 1)
    spans = [(a, a + rnd.randrange(-1, 4)) for a in (rnd.randrange(0, 20_000) for _ in range(10_000))]
    day = lambda i: start + timedelta(days=i)
    ranges = spark.createDataFrame(
        [("A", day(a), day(b)) for a, b in spans] + [("A", None, day(3)), ("A", day(3), None), (None, day(0), day(9))],
        "HotelID string, range_start date, range_end date",
    )
    out = {i for a, b in spans for i in range(a, b + 1)}
    merged = D.rows_of(exclude.merged_ranges(ranges), "range_start", "range_end")
    assert {(s - start).days + k for s, e in merged for k in range((e - s).days + 1)} == out
    assert all((b[0] - a[1]).days > 1 for a, b in zip(merged, merged[1:]))
    stays = spark.createDataFrame(
        [(h, day(i)) for h in ("A", "B") for i in range(-5, 20_010)] + [("A", None), (None, day(3))],
        "HotelID string, stay_date date",
    )
    left = exclude.drop_excluded(stays, ranges).collect()
    kept_days = [(r.stay_date - start).days for r in left if r.HotelID == "A" and r.stay_date]
    assert sorted(kept_days) == [i for i in range(-5, 20_010) if i not in out]
    assert sum(r.HotelID == "B" for r in left) == 20_015 and sum(r.HotelID is None or r.stay_date is None for r in left) == 2


def test_no_ranges_keep_all(spark):
    stays = spark.createDataFrame([("A", DAYS[0])], "HotelID string, stay_date date")
    none = spark.createDataFrame([], "HotelID string, range_start date, range_end date")
    assert exclude.drop_excluded(stays, none).columns == stays.columns
    assert exclude.drop_excluded(stays, none).count() == 1


def test_report_counts_paths_without_models(spark, hotel, tmp_path):  # noqa: F811
    matrix, params, settings = plan(hotel)
    some = params.where("day_ahead <> 2")
    table = inference.forecast(matrix, some, CONFIG, "r1", datetime(2020, 3, 1), unfitted=True)
    counters = Observation()
    rows = inference.publish(
        table, settings, CONFIG, "r1", str(tmp_path / "out"), str(tmp_path / "staged"), counters
    )
    report = {r.outcome: r.paths for r in results.run_report(spark, counters).collect()}
    done = rows.where("status = 'complete'").select("HotelID", "stay_date").distinct().count()
    assert report[results.DONE] == done > 0 and report[results.NO_MODEL] == matrix.where("day_ahead = 2").count() > 0
    assert report[results.NO_CURRENCY] == report[results.NO_PATH] == 0
    assert results.failed(rows).where(F.col("message") == results.NO_MODEL).count() == 1
    spread = predict.pickup_predict(matrix.select("HotelID", "stay_date", "day_ahead", F.lit(1.0).alias("base")), some)
    assert spread.where("day_ahead = 2").isEmpty()


def joined_inputs(spark, tmp_path):
    """Bookings and cancellations of their own, as check queries read them."""
    v = Inputs(spark, "")
    rows = [(i, "AB"[i % 2], D.STAY, 5 + i % 7, ("Confirmed", "Cancelled", "No-show")[i % 3], float(i)) for i in range(40)]
    v.bookings = D.bookings(spark, [*rows, (None, "A", D.STAY, 3, "Confirmed", 1.0)])
    v.transactions = D.transactions(spark, [(i, D.day(i % 5) if i % 3 else None) for i in range(40)])
    v.booking_status = D.statuses(spark)
    v.scratch = lambda name: f"file://{tmp_path}/{name}"
    return v


def joins(df, key="TransactionID"):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Join" in line and key in line for line in plan.splitlines())


def test_kept_periods_read_bookings_that_met_their_cancellations_once(spark, tmp_path, monkeypatch):
    v, read, changes = joined_inputs(spark, tmp_path), [], kept.changes

    def seen(rows, after, through):
        read.append(rows)
        return changes(rows, after, through)

    monkeypatch.setattr(q_runs.kept, "changes", seen)
    path = q_runs.recorded(v)
    columns = (*kept.CELL, *kept.AMOUNTS)
    whole = changes(q_rows.aware(v), None, q_runs.PERIODS[-1])
    assert joins(q_rows.aware(v)) == 1 and len(read) == 5 and not any(map(joins, read))
    assert D.rows_of(kept.state(spark, path), *columns) == D.rows_of(whole, *columns)


def test_recursive_forecast_reads_bookings_that_met_their_cancellations_once(spark, tmp_path, monkeypatch):
    v, read = joined_inputs(spark, tmp_path), []
    held = q_forecast.attached(v)
    columns = ("HotelID", "stay_date", "confirmation_date", "cancellation_date", "channel", "status", "revenue", "rooms")
    values = lambda df: sorted(map(tuple, df.select(*columns).collect()), key=str)
    for of in (q_rows.aware, q_rows.confirmed):
        assert joins(of(v)) == 1 and joins(of(held)) == 0
        assert values(of(held)) == values(of(v))

    def seen(asked, *_, **__):
        read.append(asked)
        raise InterruptedError

    monkeypatch.setattr(q_forecast, "stays_plan", seen)
    with pytest.raises(InterruptedError):
        q_forecast.recursive_forecast(v)
    assert read[0].transactions is None and joins(q_rows.aware(read[0])) == 0
