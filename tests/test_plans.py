"""Shape of the plans: what is pushed down, what is shuffled once, what must never appear."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from checks.compare import compare, database
from checks.q_forecast import FAR
from checks.q_pace import stays_plan
from checks.q_rows import aware
from pacecast.config import RunConfig
from pacecast.operators import clean, fit
from pacecast.plans import farfield, training
from pacecast.sources import tables
from tests import data as D
from tests.conftest import SMALL

QUERIES = entry_points.queries()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """Final adaptive plan, initial plans cut away."""
    df._jdf.collectToPython()
    out, skip = [], None
    for line in physical(df).split("\n"):
        depth = len(line) - len(line.lstrip(" :"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return "\n".join(out)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_crosses_its_inputs(spark, name):
    plan = physical(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_few_columns_and_pushes_the_status(spark, tmp_path):
    path = str(tmp_path / "bookings")
    D.bookings(spark, [(i, "A", D.STAY, i, "Confirmed", i) for i in range(9)]).write.parquet(path)
    plan = physical(tables.confirmed_scan(tables.read_bookings(spark, path), ["HotelID", "revenue"]))
    assert "EqualTo(status,Confirmed)" in plan
    assert "ReadSchema: struct<HotelID:string,status:string,revenue:double>" in plan


def test_lags_and_targets_share_the_bookings_shuffle(inputs):
    plan = executed(stays_plan(inputs))
    assert plan.count("ReusedExchange [HotelID") == 1


def test_far_field_evaluation_scans_the_bookings_once(inputs):
    plan = executed(farfield.evaluate(training.stays_from(aware(inputs), FAR), FAR))
    assert plan.count("partial_sum(amount") == 1


def test_grouped_fit_keeps_its_partitions(inputs):
    rows = training.model_rows(training.stays_from(aware(inputs), RunConfig()), RunConfig(lags=()))
    plan = physical(fit.linear_fit(rows, tasks=24))
    assert plan.count("REPARTITION_BY_NUM") == 2 and ", 24), REPARTITION_BY_NUM" in plan


def test_linear_training_shuffles_compact_rows_only(inputs):
    """Features are worked out after the last exchange, and no exchange follows them."""
    config = RunConfig(horizon=7, snapshots=7, lags=(7, 14), pace_features=5)
    plan = physical(training.train(stays_plan(inputs, config=config), config, "linear"))
    top = plan[: plan.index("REPARTITION_BY_NUM")]
    assert "FlatMapGroupsIn" in top and "Generate explode" in top and top.count("Exchange") == 1


def test_placed_and_plain_rows_fit_alike(inputs):
    config = RunConfig(horizon=3, snapshots=3, lags=(7,), pace_features=3)
    stays = stays_plan(inputs, config=config)
    a, b = (
        {(r.HotelID, r.day_ahead, r.target_lead): r.intercepts for r in df.collect()}
        for df in (training.train(stays, config, "linear"), fit.linear_fit(training.model_rows(stays, config)))
    )
    assert a.keys() == b.keys() and len(a) == 5 * 6
    assert all(a[k] == pytest.approx(b[k], rel=1e-3, abs=1e-3) for k in a)


def test_snapshots_are_exploded_after_the_last_shuffle(inputs):
    plan = physical(training.training_matrix(stays_plan(inputs), RunConfig()))
    generate = plan.index("Generate posexplode")
    assert "Exchange hashpartitioning" not in plan[:generate] and "Exchange hashpartitioning" in plan[generate:]


@pytest.mark.parametrize(
    "name", ["p04_j03_j04_training_matrix", "m07_f04_forecast_table", "n04_summary_rows", "g10_j09_u02_metric_summary"]
)
def test_results_hold_without_any_broadcast(spark, name):
    """Every side may outgrow a broadcast; the shuffled plan gives the same rows."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        df = QUERIES[name](spark, SMALL)
        assert "BroadcastHashJoin" not in physical(df)
        assert compare(df, database(SMALL), entry_points.oracle_sql()[name]).startswith("ok")
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_one_hot_hotel_and_transaction_give_whole_results(spark):
    """One hotel and one transaction hold most rows; sums must not lose any."""
    rows = [(1, "HOT", D.STAY, i % 50, "Confirmed", 1) for i in range(4000)]
    rows += [(2 + i, f"h{i % 20}", D.STAY, i % 50, "Confirmed", 1) for i in range(2000)]
    config = RunConfig(horizon=5, snapshots=5, lead_window=20, lags=())
    args = D.bookings(spark, rows), D.transactions(spark, [(3, D.day(1))]), D.statuses(spark)
    stays = training.stays_from(training.aware_bookings(*args, config), config)
    totals = dict(stays.select("HotelID", "total").collect())
    assert totals["HOT"] == 4000 and sum(totals.values()) == 4000 + 1999
    assert stays.select(F.max(F.size("cells"))).first()[0] <= 20 * 6


def test_hot_transaction_is_split_by_the_skew_join(spark, tmp_path):
    """Half of all bookings share a transaction; the left side of that join partition is read in pieces."""
    path = str(tmp_path / "b")
    rows = [(1 if i % 2 else 10 + i, "A", D.STAY, i % 50, "Confirmed", i) for i in range(6000)]
    D.bookings(spark, rows).repartition(12).write.parquet(path)
    seen = D.transactions(spark, [(10 + i, D.day(1)) for i in range(6000)])
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, value in small.items():
        spark.conf.set(k, value)
    try:
        joined = clean.attach_cancellations(tables.read_bookings(spark, path), seen)
        daily = clean.daily_net(joined, with_cancellation=True)
        plan = executed(daily)
        assert "SortMergeJoin(skew=true)" in plan
        assert daily.agg(F.sum("rooms")).first()[0] == 6000.0
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
