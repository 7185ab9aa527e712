"""The filter of cancelled ids, targets by status, and records of log files read in blocks."""

import random
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from pacecast.config import FarFieldConfig, RunConfig
from pacecast.operators import clean, logs
from pacecast.plans import training
from pacecast.sources import tables
from tests import data as D

BITS = clean.BLOCK_BITS


def test_filter_misses_no_key(spark):
    """Every key is found; with far fewer keys than bits hardly any other is; nulls never are."""
    keys = spark.range(0, 9000, 3).withColumnRenamed("id", "k")
    asked = spark.range(9000).withColumnRenamed("id", "k").unionByName(spark.createDataFrame([(None,)] * 5, "k long"))
    found = clean.key_filter(keys.unionByName(spark.createDataFrame([(None,)], "k long")), "k", 32 * BITS)
    got = clean.may_hold(asked, found, "k", 32 * BITS, "may").groupBy((F.col("k") % 3 == 0).alias("own"), "may").count()
    counts = {(r["own"], r["may"]): r["count"] for r in got.collect()}
    assert counts[True, True] == 3000 and (True, False) not in counts
    assert counts[None, False] == 5 and counts.get((False, True), 0) < 60


def test_filter_size_is_fixed(spark):
    found = clean.key_filter(spark.range(200_000), "id", 4 * BITS).collect()
    assert sorted(r["block"] for r in found) == [0, 1, 2, 3]
    assert all(len(r["words"]) == BITS // clean.WORD_BITS for r in found)
    with pytest.raises(ValueError):
        clean.key_filter(spark.range(3), "id", BITS + 1)


@pytest.mark.parametrize("bits", [BITS, 64 * BITS])
def test_candidates_read_the_same_dates(spark, bits):
    """A filter too small for its keys (all false hits) and one of ample size, null ids, no cancelled id at all."""
    rng = random.Random(3)
    rows = [(rng.choice([None, i % 4000]), "A", D.STAY, i % 20, "Confirmed", i) for i in range(9000)]
    seen = [(i, D.day(i % 9) if i % 5 == 0 else None) for i in range(4000)] + [(10**9 + i, D.day(1)) for i in range(60_000)]
    bookings = D.bookings(spark, rows)
    for transactions in (D.transactions(spark, seen), D.transactions(spark, [(1, None)])):
        plain, split = (
            sorted(map(tuple, df.select("TransactionID", "revenue", "cancellation_date").collect()), key=lambda r: r[1])
            for df in (clean.attach_cancellations(bookings, transactions), clean.attach_to_candidates(bookings, transactions, bits))
        )
        assert plain == split


def test_only_candidates_are_shuffled(spark, tmp_path):
    """Without broadcasting of tables the exchange of bookings holds the few that may be cancelled."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        bookings = D.bookings(spark, [(i, "A", D.STAY, 3, "Confirmed", i) for i in range(2000)])
        transactions = D.transactions(spark, [(i, D.day(1)) for i in range(0, 2000, 20)])
        joined = clean.attach_to_candidates(bookings, transactions, 32 * BITS)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        met, rest = plan[plan.index("Union") :].split("SortMergeJoin")[1].split("Exchange hashpartitioning(TransactionID", 1)
        assert "getbit" in rest.split("Exchange hashpartitioning")[0]  # the filter stands below the bookings' exchange
        assert plan.count("Exchange hashpartitioning(TransactionID") == 2  # bookings that may match, and transactions
        assert clean.may_hold(bookings, clean.key_filter(transactions, "TransactionID", 32 * BITS), "TransactionID", 32 * BITS, "m").where("m").count() < 130
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_training_with_a_filter_equals_training_without(inputs):
    v, out = inputs, []
    for bits in (0, 32 * BITS):
        config = RunConfig(horizon=5, lags=(), filter_bits=bits)
        stays = training.training_stays(v.bookings, v.transactions, v.booking_status, config, partition_date=date(1997, 1, 1))
        out.append({(r.HotelID, r.stay_date): r for r in stays.collect()})
    assert out[0].keys() == out[1].keys() and len(out[0]) > 100
    assert all(out[1][k].total == pytest.approx(r.total) and len(out[1][k].cells) == len(r.cells) for k, r in out[0].items())


def test_targets_by_status(spark):
    """A confirmed booking with a cancellation date counts for targets alone; cancelled ones count for features alone."""
    rows = [
        (1, "A", D.STAY, 40, "Confirmed", 100),
        (2, "A", D.STAY, 50, "Confirmed", 10),  # cancelled later by its date
        (3, "A", D.STAY, 60, "Cancelled", 1),
        (4, "B", D.STAY, 60, "Cancelled", 1),  # no target
        (5, "C", D.STAY, 60, "Confirmed", 1),  # target without features
        (6, "D", D.STAY, 60, "Other", 1),
        (7, "A", D.STAY, 60, None, 1000),
    ]
    gone = [(2, D.day(30)), (3, D.day(2)), (4, D.day(2)), (5, D.day(2))]
    args = D.bookings(spark, rows), D.transactions(spark, gone), D.statuses(spark)
    config = FarFieldConfig(lags=(), targets_by_status=True)
    stays = training.stays_from(training.aware_bookings(*args, config), config).collect()
    assert [(r.HotelID, r.total) for r in stays] == [("A", 110.0)]
    assert sorted((c.lead, c.gone, c.amount) for c in stays[0].cells) == [(40, -1, 100.0), (60, 2, 1.0)]
    plain = replace(config, targets_by_status=False)
    stays = training.stays_from(training.aware_bookings(*args, plain), plain).collect()
    assert [(r.HotelID, r.total) for r in stays] == [("A", 100.0)]
    with pytest.raises(ValueError):
        RunConfig(targets_by_status=True, cancel_aware=False)


def test_status_in_both_scenarios_counts_for_both(spark):
    both = spark.createDataFrame([("confirmed", "X"), ("cancelled", "X")], "scenario string, status string")
    args = D.bookings(spark, [(1, "A", D.STAY, 9, "X", 5)]), D.transactions(spark, [(1, D.day(2))]), both
    config = FarFieldConfig(lags=(), targets_by_status=True)
    stay = training.stays_from(training.aware_bookings(*args, config), config).first()
    assert stay.total == 5.0 and [(c.lead, c.gone) for c in stay.cells] == [(9, 2)]


def test_log_records_cross_blocks(spark, tmp_path):
    """Traces longer than a block stay with their message, whatever the size of the blocks."""
    rng, want, lines = random.Random(1), [], ["a line above all records"]
    for i in range(120):
        failed = i % 3 == 0
        message = f"2024-01-{1 + i % 28:02d} 10:00:00,1 - ERROR - {logs.ERROR_TEXT if failed else 'fine'} {i}: no model"
        below = [f"  at step {k} of {i} " + "x" * rng.randint(0, 40) for k in range(rng.choice([0, 1, 2, 60]))]
        tail = [""] if rng.random() < 0.3 else []
        lines += [message, *below, *tail]
        if failed:
            want.append((message, len(below) + len(tail), below[-1] if below else None))
    for name in ("one", "two"):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    (tmp_path / "empty").write_text("")
    for size in ("256B", "3KB", "128MB"):
        session = spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", size)
        blocks = tables.read_log_blocks(session, f"file://{tmp_path}")
        assert size == "128MB" or blocks.select("file", "block").distinct().count() > 10
        got = logs.log_records(blocks).collect()
        for name in ("one", "two"):
            own = sorted(((r.value, r.n_below, r.last_below) for r in got if r.file.endswith(name)), key=str)
            assert own == sorted(want, key=str)


def test_log_blocks_share_tasks(spark):
    """Many blocks in one task, batches that end inside a trace, null lines."""
    rng, want, rows = random.Random(2), [], []
    for i in range(400):
        kind = rng.choice([logs.ERROR_TEXT, "fine", "fine"])
        message = f"2024-01-01 10:00:00,1 - {kind} {i}: x"
        below = [rng.choice(["  at", "", " ", "\t", f"KeyError {i}", None]) for _ in range(rng.choice([0, 0, 1, 3, 30]))]
        rows += [message, *below]
        if kind == logs.ERROR_TEXT:
            filled = [b for b in below if b is not None and b.strip(" ")]
            want.append((message, len(below), filled[-1] if filled else None))
    text = [(file, i // 7 * 100, line) for file in ("one", "two") for i, line in enumerate(["none", *rows])]
    blocks = spark.createDataFrame(text, "file string, block long, value string").coalesce(1)
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("5", "11", held):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = logs.log_records(blocks).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
        for file in ("one", "two"):
            assert sorted(((r.value, r.n_below, r.last_below) for r in got if r.file == file), key=str) == sorted(want, key=str)


def test_log_records_tasks_are_bounded(spark, tmp_path, monkeypatch):
    """a09 reads its blocks in at most the tasks that the session works with, however many blocks there are."""
    from checks import q_logs
    from checks.registry import Inputs

    read, parts = tables.read_log_blocks, []

    def counted(session, path):
        blocks = read(session, path)
        parts.append((blocks.select("file", "block").distinct().count(), blocks.rdd.getNumPartitions()))
        return blocks

    monkeypatch.setattr(q_logs.tables, "read_log_blocks", counted)
    monkeypatch.setattr(q_logs.pace, "work_tasks", lambda spark: 3)
    lines = spark.range(3000).selectExpr(
        "cast(id % 2 as string) as driver", "id", "0 as n_trace", "concat('2024-01-01 10:00:00 - fine ', repeat('x', 50)) as value"
    )
    v = Inputs(spark, "")
    v.traced_lines, v.scratch = lines, lambda name: f"file://{tmp_path}/{name}"
    assert q_logs.a09(v).count() == 0
    assert parts[0][0] > 6 and parts[0][1] <= 3
