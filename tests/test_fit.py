import itertools
import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pacecast.config import FarFieldConfig, RunConfig
from pacecast.operators import fit, predict, results
from pacecast.sources import sinks
from pacecast.plans import farfield, inference, training
from pacecast.schema import FORECAST
from tests import data as D

ROW = "HotelID string, stay_date date, day_ahead int, y array<double>, base double, x array<double>"


def pinball(r, q):
    return np.where(r >= 0, q * r, (q - 1) * r).mean()


def line(X, y, q, ridge=0.0):
    """Predictions of the fitted line at X."""
    a, slopes, rested = fit.SharedDesign(X, ridge).solve(y[:, None], (q,), np.array([X.shape[1]]))
    return a[0] + X @ slopes[:, 0], rested[0]


@pytest.mark.parametrize("q", [0.1, 0.5, 0.9])
def test_pinball_solver_reaches_the_best_line(q):
    """The best quantile line passes through two points: try all pairs."""
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 10, 60)
    y = 3 + 2 * x + rng.exponential(4, 60)
    X = np.column_stack([np.ones(60), x])
    best = min(
        pinball(y - X @ np.linalg.solve(X[[i, j]], y[[i, j]]), q) for i, j in itertools.combinations(range(60), 2)
    )
    assert pinball(y - line(x[:, None], y, q)[0], q) <= best * 1.005


def test_solver_survives_constant_and_repeated_columns():
    X = np.column_stack([np.zeros(30), np.full(30, 7.0), np.arange(30), np.arange(30)])
    found, _ = line(X, np.arange(30) * 2.0, 0.5)
    assert np.allclose(found, np.arange(30) * 2.0, atol=0.5)
    assert np.allclose(line(X, np.full(30, 4.0), 0.9)[0], 4.0)


def test_solver_says_whether_it_came_to_rest(monkeypatch):
    X, noise = np.arange(30.0)[:, None], np.random.default_rng(0).normal(size=30)
    assert line(X, 2.0 * np.arange(30) + noise, 0.5, 1e-4)[1]
    monkeypatch.setattr(fit, "STEPS", 1)
    assert not line(X, 2.0 * np.arange(30) + noise, 0.5, 1e-4)[1]


def test_targets_together_are_fitted_as_alone():
    """All targets, quantiles and widths of one design share its factor; each has the line it has by itself."""
    rng = np.random.default_rng(8)
    X = rng.normal(size=(120, 6))
    Y = X @ rng.normal(size=(6, 4)) + rng.exponential(2, (120, 4))
    width, quantiles = np.array([2, 6, 4, 0]), (0.1, 0.5, 0.9)
    a, slopes, _ = fit.SharedDesign(X, 1e-4).solve(Y, quantiles, width)
    for j, w in enumerate(width):
        for i, q in enumerate(quantiles):
            own, at = line(X[:, :w], Y[:, j], q, 1e-4)[0], 3 * j + i
            assert (slopes[w:, at] == 0).all()
            assert pinball(Y[:, j] - a[at] - X @ slopes[:, at], q) == pytest.approx(pinball(Y[:, j] - own, q), rel=2e-3)
    assert a[9:].tolist() == pytest.approx([np.quantile(Y[:, 3], q) for q in quantiles])


def test_quantile_lines_leave_their_share_below():
    rng = np.random.default_rng(2)
    X = np.cumsum(rng.exponential(1, (300, 40)), axis=1)
    Y = X[:, :2] + rng.exponential(1, (300, 2)) * X[:, 1:3]
    a, slopes, rested = fit.SharedDesign(X, 1e-4).solve(Y, (0.1, 0.5, 0.9), np.array([40, 40]))
    rest = np.repeat(Y, 3, axis=1) - a - X @ slopes
    assert rested.all() and np.abs((rest < 0).mean(axis=0) - np.tile([0.1, 0.5, 0.9], 2)).max() <= 1 / 300


def sample_rows(n=80, d=3):
    rnd = random.Random(1)
    out = []
    for i in range(n):
        a, b = rnd.uniform(0, 9), rnd.uniform(0, 9)
        y = [a + k + rnd.uniform(0, 1) for k in range(d)]
        out.append(("A", D.day(i), d, y, a, [a, b]))
    return out


def test_pickup_fit_is_the_exact_percentile(spark):
    rows = sample_rows()
    params = fit.pickup_fit(spark.createDataFrame(rows, ROW), (0.1, 0.5, 0.9)).collect()
    assert sorted(p.target_lead for p in params) == [0, 1, 2]
    for p in params:
        pickups = [r[3][2 - p.target_lead] - r[4] for r in rows]
        assert p.offsets == pytest.approx(np.percentile(pickups, [10, 50, 90]).tolist())


def test_pickup_predict_in_path_order(spark):
    rows = spark.createDataFrame(sample_rows(), ROW)
    params = fit.pickup_fit(rows)
    offsets = {p.target_lead: p.offsets for p in params.collect()}
    for r in predict.pickup_predict(rows, params).collect():
        assert r.target_leads == [2, 1, 0]
        assert r.y_med_raw == pytest.approx([r.base + offsets[t][1] for t in (2, 1, 0)])
        assert r.y_upper_raw == pytest.approx([r.base + offsets[t][2] for t in (2, 1, 0)])


@pytest.mark.parametrize("recursive", [False, True])
def test_linear_path_feeds_medians_forward(spark, recursive):
    rows = spark.createDataFrame(sample_rows(), ROW)
    params = fit.linear_fit(rows, recursive=recursive, tasks=2).cache()
    by_lead = {p.target_lead: p for p in params.collect()}
    assert [len(by_lead[t].path_coefs[0]) for t in (2, 1, 0)] == ([0, 1, 2] if recursive else [0, 0, 0])
    for r in predict.linear_predict(rows, params).collect():
        medians = []
        for pos, lead in enumerate((2, 1, 0)):
            p = by_lead[lead]
            point = [
                p.intercepts[i] + np.dot(p.coefs[i], r.x) + np.dot(p.path_coefs[i], medians[: len(p.path_coefs[i])])
                for i in range(3)
            ]
            assert (r.y_lower_raw[pos], r.y_med_raw[pos], r.y_upper_raw[pos]) == pytest.approx(tuple(point))
            medians.append(point[1])


def test_linear_fit_covers_about_its_quantiles(spark):
    rows = spark.createDataFrame(sample_rows(400, 1), ROW)
    got = predict.linear_predict(rows, fit.linear_fit(rows, tasks=2)).collect()
    below = [np.mean([r.y[0] < r[c][0] for r in got]) for c in predict.RAW]
    assert below == pytest.approx([0.1, 0.5, 0.9], abs=0.04)


def test_rows_with_unknown_targets_are_left_out(spark):
    rows = sample_rows(30, 2)
    broken = rows + [("A", D.day(99), 2, [None, 1e9], 0.0, [0.0, 0.0])]
    a = fit.linear_fit(spark.createDataFrame(rows, ROW), tasks=1).orderBy("target_lead").collect()
    b = fit.linear_fit(spark.createDataFrame(broken, ROW), tasks=1).orderBy("target_lead").collect()
    assert [r.intercepts for r in a] == [pytest.approx(r.intercepts) for r in b]


def test_distances_without_parameters_are_skipped_and_reported(spark):
    rows = spark.createDataFrame(sample_rows(20, 2) + [("A", D.day(5), 9, [1.0] * 9, 1.0, [1.0, 1.0])], ROW)
    params = fit.pickup_fit(rows.where("day_ahead = 2"))
    assert predict.pickup_predict(rows, params).where("day_ahead = 9").isEmpty()
    assert D.rows_of(predict.missing_distances(rows, params), "HotelID", "day_ahead") == [("A", 9)]


# ---- whole plans on a small hotel ----

CONFIG = RunConfig(horizon=4, snapshots=4, lead_window=10, lags=(5, 7))
START = date(2020, 3, 1)


@pytest.fixture(scope="module")
def hotel(spark):
    rnd, rows, t = random.Random(2), [], 0
    for offset in range(-60, 5):
        stay = START + timedelta(days=offset)
        for _ in range(rnd.randint(2, 6)):
            t += 1
            rows.append((t, "A", stay, rnd.randint(0, 9), "Confirmed", rnd.randint(5, 20)))
    args = D.bookings(spark, rows), D.transactions(spark, []), D.statuses(spark)
    settings = spark.createDataFrame(
        [("A", "US", "NY", 10, 4, 3, "USD"), ("B", "US", "NY", 10, 4, 3, "USD")],
        "HotelID string, Country string, State string, lead_window int, inference_length int, available_rooms int, "
        "forecast_currency string",
    )
    return args, settings


def plan(hotel, config=CONFIG, method="pickup"):
    args, settings = hotel
    stays = training.training_stays(*args, config, partition_date=START)
    confirmed = training.confirmed_bookings(*args, config)
    matrix = inference.inference_matrix(confirmed, config, settings, START)
    return matrix, training.train(stays, config, method), settings


@pytest.mark.parametrize("method", ["pickup", "linear"])
def test_forecast_has_the_published_columns_and_starts_at_what_is_known(spark, hotel, method):
    matrix, params, _ = plan(hotel, method=method)
    table = inference.forecast(matrix, params, CONFIG, "r1", datetime(2020, 3, 1), method)
    assert table.columns == FORECAST.fieldNames()
    known = {(r.stay_date): r.pace[r.day_ahead] for r in matrix.collect()}
    got = table.collect()
    assert {r.stay_date for r in got} == set(known)
    for r in got:
        ahead = (r.stay_date - START).days
        assert r.booking_date == START + timedelta(days=r.day_index) and 0 <= r.day_index <= ahead
        if r.day_index == 0:
            assert r.y_med == known[r.stay_date]


def test_training_and_inference_trim_the_same_slots(hotel):
    args, settings = hotel
    narrow = settings.withColumn("lead_window", F.lit(6))
    stays = training.training_stays(*args, CONFIG, narrow, partition_date=START)
    for r in training.model_rows(stays, CONFIG).collect():
        seen = r.x[: 10 - r.day_ahead]
        assert all(v == 0.0 for v in seen[6 - r.day_ahead:]) and len(seen) == 10 - r.day_ahead
    matrix = inference.inference_matrix(training.confirmed_bookings(*args, CONFIG), CONFIG, narrow, START)
    assert all(r.pace[6:] == [None] * 4 for r in matrix.collect())


def test_room_forecasts_are_capped_and_carry_no_currency(hotel):
    config = RunConfig(target_type="ROOMS", horizon=4, snapshots=4, lead_window=10, lags=())
    matrix, params, _ = plan(hotel, config)
    table = inference.forecast(matrix, params, config, "r1", datetime(2020, 3, 1))
    done = results.completed(table, "ROOMS")
    assert "forecast_currency" not in done.columns and "status" not in done.columns
    assert done.where("day_index > 0").agg(F.max("y_upper")).first()[0] <= 3.0


def test_revenue_without_currency_is_an_error_when_strict(hotel):
    matrix, params, _ = plan(hotel)
    bare = matrix.withColumn("forecast_currency", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="currency"):
        inference.forecast(bare, params, CONFIG, "r1", datetime(2020, 3, 1), strict=True).collect()


def test_paths_fail_alone_and_say_why(hotel):
    matrix, params, _ = plan(hotel)
    some = F.when(F.col("day_ahead") > 2, F.col("forecast_currency"))
    rows = inference.forecast(matrix.withColumn("forecast_currency", some), params, CONFIG, "r1", datetime(2020, 3, 1))
    each = results.one_failure_each(rows)
    lost = results.failed(each).collect()
    assert [(r.HotelID, r.stay_date, r.message, r.y_med) for r in lost] == [("A", date(1900, 1, 1), results.NO_CURRENCY, 0.0)]
    good = each.where("status = 'complete'")
    assert good.count() > 0 and good.where("forecast_currency is null").count() == 0
    nothing = params.withColumn("offsets", F.array(*[F.lit(None).cast("double")] * 3))
    lost = results.one_failure_each(inference.forecast(matrix, nothing, CONFIG, "r1", datetime(2020, 3, 1))).collect()
    assert [(r.status, r.message) for r in lost] == [("incomplete", results.NO_PATH)]


def test_rooms_without_a_count_fail_alone(hotel):
    config = RunConfig(target_type="ROOMS", horizon=4, lead_window=10, lags=())
    matrix, params, _ = plan(hotel, config)
    bare = matrix.withColumn("available_rooms", F.lit(None).cast("int"))
    rows = results.one_failure_each(inference.forecast(bare, params, config, "r1", datetime(2020, 3, 1))).collect()
    assert [(r.status, r.message) for r in rows] == [("incomplete", "available_rooms must be provided")]


def test_lead_windows_past_the_configured_one_are_refused(hotel):
    args, settings = hotel
    wide = settings.withColumn("lead_window", F.lit(11))
    with pytest.raises(ValueError, match="lead window"):
        inference.inference_matrix(training.confirmed_bookings(*args, CONFIG), CONFIG, wide, START)


def test_distances_need_their_snapshots_and_leads():
    assert RunConfig(horizon=40).snapshots == 40 and FarFieldConfig(points=(119, 35)).targets == 113
    for bad in (dict(horizon=40, snapshots=28), dict(horizon=100), dict(horizon=28, lead_window=28)):
        with pytest.raises(ValueError):
            RunConfig(**bad)
    with pytest.raises(ValueError):
        FarFieldConfig(points=(160,))


def test_publish_stages_reports_and_appends(spark, hotel, tmp_path):
    matrix, params, settings = plan(hotel)
    table = inference.forecast(matrix, params, CONFIG, "r1", datetime(2020, 3, 1))
    out = str(tmp_path / "forecasts")
    everything = inference.publish(table, settings, CONFIG, "r1", out, str(tmp_path / "staged"))
    lost = results.failed(everything).collect()
    assert [(r.HotelID, r.stay_date, r.y_med, r.message) for r in lost] == [
        ("B", date(1900, 1, 1), 0.0, inference.NO_DATA)
    ]
    assert tuple(results.run_summary(everything).first()) == (1, 2)
    assert spark.read.parquet(out).count() == everything.count() - 1
    again = inference.publish(table, settings, CONFIG, "r1", out, str(tmp_path / "staged again"))
    assert spark.read.parquet(out).count() == again.count() - 1  # a repeated run adds nothing
    other = inference.forecast(matrix, params, CONFIG, "r2", datetime(2020, 3, 2))
    inference.publish(other, settings, CONFIG, "r2", out, str(tmp_path / "staged r2"))
    assert spark.read.parquet(out).count() == 2 * (everything.count() - 1)
    sinks.drop_stage(spark, str(tmp_path / "staged"))
    assert not (tmp_path / "staged").exists()


def test_holdout_uses_each_stays_own_distance(hotel):
    args, _ = hotel
    config = RunConfig(horizon=4, snapshots=4, lead_window=10, lags=())
    stays = training.stays_from(training.aware_bookings(*args, config), config)
    train, test = training.holdout(stays, config)
    last = stays.agg(F.max("stay_date")).first()[0]
    assert train.agg(F.max("stay_date")).first()[0] < last - timedelta(days=4)
    picked = D.rows_of(training.holdout_model_rows(test, config), "stay_date", "day_ahead")
    assert picked == [(last - timedelta(days=4 - d), d) for d in range(1, 5)]
    rows = results.holdout_rows(
        predict.pickup_predict(training.holdout_model_rows(test, config), training.train(train, config))
    )
    assert rows.count() == 1 + 2 + 3 + 4


@pytest.mark.parametrize("method", ["pickup", "linear"])
def test_far_field_absent_stay_reads_zero(spark, method):
    rows, t = [], 0
    for offset in range(-60, 1):
        if offset == -9 + 6:  # the stay that point 6 is checked on
            continue
        t += 1
        rows.append((t, "A", START + timedelta(days=offset), 12, "Confirmed", 10 + offset % 3))
    config = FarFieldConfig(points=(9, 6), step=2, lead_window=15, snapshots=10, lags=(10,))
    args = D.bookings(spark, rows), D.transactions(spark, []), D.statuses(spark)
    stays = training.training_stays(*args, config, partition_date=START)
    got = {r.prediction_point: r for r in farfield.evaluate(stays, config, method).collect()}
    assert got[6].y_true == got[6].y_pred == got[6].y_lower == got[6].y_upper == 0.0
    assert got[9].y_true > 0 and got[9].y_lower <= got[9].y_pred <= got[9].y_upper
