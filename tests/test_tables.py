"""Versions, logs, sinks."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from pacecast.config import RunConfig
from pacecast.operators import logs, versions
from pacecast.plans import training
from pacecast.schema import MODEL_VERSIONS
from pacecast.sources import sinks, tables
from tests import data as D


@pytest.fixture()
def listed(spark):
    rows = [
        ("m0", 1, "yes", "no"), ("m0", 2, "no", "no"), ("m0", 3, "no", "yes"),
        ("m1", 1, "yes", "yes"), ("m1", 2, "yes", "no"), ("m2", 1, "no", "no"),
    ]
    return spark.createDataFrame(rows, MODEL_VERSIONS)


def test_latest_version_prefers_the_newest_tagged(listed):
    assert D.rows_of(versions.latest_version(listed), "model_name", "version") == [("m0", 3), ("m1", 2), ("m2", 1)]
    assert D.rows_of(versions.latest_version(listed, "dev"), "model_name", "version") == [("m0", 1), ("m1", 2)]
    with pytest.raises(PySparkException, match="m2"):
        versions.require_version(listed, listed, "dev").collect()


def test_promotion_keeps_one_yes(listed):
    got = D.rows_of(versions.promote(listed, "dev"), "model_name", "version", "stage_dev")
    assert [g for g in got if g[2] == "yes"] == [("m0", 1, "yes"), ("m1", 2, "yes")] and len(got) == 6


def test_log_report(spark, tmp_path):
    good = "2020-03-31 08:00:00,1 - x - INFO - Processing Hotel 7\n"
    bad = "2020-03-31 {h}:30:00,1 - x - ERROR - Error encountered when processing hotel 7: no model: gone\n"
    for i in range(5):
        (tmp_path / f"stderr-{i}").write_text(good + (bad.format(h=f"0{i}") * i))
    hits = logs.error_lines(tables.read_logs(spark, str(tmp_path)))
    counts = sorted((r.file[-1], r.errors) for r in logs.error_counts(hits).collect())
    assert counts == [("1", 1), ("2", 2), ("3", 3), ("4", 4)]
    assert {(r.HotelID, r.message) for r in hits.collect()} == {("7", "no model: gone")}
    late = logs.error_lines(tables.read_logs(spark, str(tmp_path)), start=datetime(2020, 3, 31, 3), end=datetime(2020, 3, 31, 4))
    assert late.count() == 3
    with pytest.raises(RuntimeError, match="stderr-4"):
        logs.fail_on_errors(hits)
    logs.fail_on_errors(hits.where("false"))


def small(spark):
    return spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "HotelID string, v int")


def test_overwrite_and_append_by_hotel(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(small(spark), path)
    assert (tmp_path / "t" / "HotelID=A").is_dir()
    sinks.append(small(spark), path)
    assert spark.read.parquet(path).count() == 6
    sinks.overwrite(small(spark).withColumnRenamed("v", "w"), path)
    assert set(spark.read.parquet(path).columns) == {"HotelID", "w"}
    plan = spark.read.parquet(path).where("HotelID = 'A'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(HotelID" in plan


def test_external_table_rebuild_and_stage(spark, tmp_path):
    spark.sql("drop table if exists pace_t")
    sinks.append(small(spark), "pace_t", path=str(tmp_path / "ext"))
    assert spark.table("pace_t").count() == 3 and (tmp_path / "ext" / "HotelID=B").is_dir()
    spark.sql("drop table pace_t")
    spark.sql("drop table if exists pace_m")
    try:
        sinks.append_metrics(small(spark), "pace_m")
        sinks.append_metrics(small(spark), "pace_m")
        assert spark.table("pace_m").count() == 6
        sinks.rebuild(small(spark), "pace_m")
        assert spark.table("pace_m").count() == 3
    finally:
        spark.sql("drop table if exists pace_m")
    staged = sinks.stage(small(spark), str(tmp_path / "s"))
    assert staged.count() == 3 and "FileScan" in staged._jdf.queryExecution().executedPlan().toString()


def test_stage_uses_the_shared_checkpoint_folder(spark, tmp_path):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            sinks.stage(small(spark))


def test_matrix_is_written_and_read_again(spark, tmp_path):
    config = RunConfig(horizon=3, snapshots=3, lead_window=5, lags=(1,))
    rows = [(i, "AB"[i % 2], D.day(i), i % 4, "Confirmed", i) for i in range(20)]
    stays = training.training_stays(
        D.bookings(spark, rows), D.transactions(spark, []), D.statuses(spark), config, partition_date=D.STAY
    )
    training.write_matrix(stays, config, str(tmp_path / "m"))
    back = tables.read_table(spark, str(tmp_path / "m"))
    assert back.count() == 20 * 3
    columns = ("stay_date", "forecast_index", "pace", "target")
    assert D.rows_of(back, *columns) == D.rows_of(training.training_matrix(stays, config), *columns)


def test_hotel_ids_of_digits_stay_text(spark, tmp_path):
    from pacecast import schema as S
    from pacecast.sources import sinks, tables

    row = (1, "007", None, None, "WEB", "Confirmed", 1.0, 1.0)
    path = f"{tmp_path}/bookings"
    sinks.overwrite(spark.createDataFrame([row], S.BOOKINGS), path)
    assert [r.HotelID for r in tables.read_bookings(spark, path).collect()] == ["007"]


def test_replaced_parts_leave_the_others(spark, tmp_path):
    from pacecast.sources import sinks

    path = f"{tmp_path}/runs"
    write = lambda rows: sinks.replace_parts(spark.createDataFrame(rows, "x int, run_id string, HotelID string"), path)
    write([(1, "a", "h1"), (2, "a", "h2"), (3, "b", "h1")])
    write([(5, "a", "h1")])
    write([(5, "a", "h1")])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(2, "a", "h2"), (3, "b", "h1"), (5, "a", "h1")]
