"""Sources and sinks: tables written below the shared folder, read back and compared with what they should hold."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.q_rows import BY_KIND, by_kind, confirmed
from checks.registry import check
from pacecast import schema as S
from pacecast.config import evaluation_window
from pacecast.sources import sinks, tables

TODAY = date(2001, 7, 2)


@check("a07_checked_read", "bookings", f"select HotelID, status, {BY_KIND} from bookings group by 1, 2")
def a07(v):
    """A written bookings table, read against its schema."""
    path = v.scratch("bookings")
    sinks.overwrite(v.bookings.select(*S.BOOKINGS.fieldNames()), path)
    return by_kind(tables.read_bookings(v.spark, path), "HotelID", "status")


@check("a10_overwrite", "bookings", f"select HotelID, {BY_KIND} from bookings where status = 'Confirmed' group by 1")
def a10(v):
    """The second write replaces the first whole."""
    path = v.scratch("overwrite")
    sinks.overwrite(v.bookings, path)
    sinks.overwrite(v.bookings.where("status = 'Confirmed'"), path)
    return by_kind(tables.read_table(v.spark, path).withColumn("HotelID", F.col("HotelID").cast("string")), "HotelID")


@check("a11_append", "bookings", f"select HotelID, status, {BY_KIND} from bookings group by 1, 2")
def a11(v):
    """Two appends of disjoint rows are the table."""
    path = v.scratch("append")
    sinks.append(v.bookings.where("status = 'Confirmed'"), path)
    sinks.append(v.bookings.where("not status <=> 'Confirmed'"), path)
    return by_kind(tables.read_table(v.spark, path).withColumn("HotelID", F.col("HotelID").cast("string")), "HotelID", "status")


@check("a12_stage_and_drop", "bookings", f"select status, {BY_KIND} from bookings group by 1")
def a12(v):
    """What is read from a later stage does not need the earlier one any more."""
    first, second = v.scratch("stage"), v.scratch("stage")
    counted = sinks.stage(by_kind(sinks.stage(v.bookings, first), "status"), second)
    sinks.drop_stage(v.spark, first)
    if sinks.existing(v.spark, first) is not None:
        raise AssertionError(f"{first} is still there")
    return counted


@check(
    "a13_append_metrics",
    "bookings",
    f"""select 1 as run, HotelID, {BY_KIND} from bookings group by 2
        union all select 2 as run, status as HotelID, {BY_KIND} from bookings group by 2""",
)
def a13(v):
    path = v.scratch("metrics")
    for run, key in ((1, "HotelID"), (2, "status")):
        sinks.append_metrics(by_kind(v.bookings, key).withColumnRenamed(key, "HotelID").withColumn("run", F.lit(run)), path)
    return tables.read_table(v.spark, path).select("run", "HotelID", "n", "revenue", "rooms")


@check(
    "a14_replace_runs",
    "bookings",
    f"""select 'r1' as run_id, HotelID, {BY_KIND} from bookings group by 2
        union all select 'r2' as run_id, HotelID, {BY_KIND} from bookings
          where HotelID not in ('0', '1') or status = 'Confirmed' group by 2""",
)
def a14(v):
    """Two runs; the second fails half way and is repeated, then two of its hotels are written anew."""
    path = v.scratch("runs")
    rows = v.bookings.select("HotelID", "status", "revenue", "rooms")
    run = lambda name, df: sinks.replace_parts(df.withColumn("run_id", F.lit(name)), path)
    run("r1", rows)
    run("r2", rows.where("HotelID = '0'"))
    run("r2", rows)
    run("r2", rows.where("HotelID in ('0', '1') and status = 'Confirmed'"))
    found = tables.read_table(v.spark, path).withColumn("HotelID", F.col("HotelID").cast("string"))
    return by_kind(found, "run_id", "HotelID")


@check(
    "f16_unknown_hotels",
    "bookings hotel_config",
    """select distinct cast(TransactionID % 9 as varchar) as HotelID from bookings
       where cast(TransactionID % 9 as varchar) not in (select HotelID from hotel_config where HotelID is not null)""",
)
def f16(v):
    requested = v.bookings.select((F.col("TransactionID") % 9).cast("string").alias("HotelID"))
    return tables.unknown_hotels(requested, v.hotel_config)


@check(
    "n06_evaluation_window",
    "confirmed",
    f"""select HotelID, {BY_KIND} from confirmed
        where stay_date >= date '{TODAY}' - 30 and stay_date <= date '{TODAY}' - 2 group by 1""",
)
def n06(v):
    start, end = evaluation_window(TODAY, 28)
    return by_kind(tables.calendar_scan(confirmed(v), start, end), "HotelID")
