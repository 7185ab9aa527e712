"""Work of repeated runs: kept cells, the watermark from footers, merged exclusions, the run report."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks.q_forecast import ORIGIN
from checks.q_pace import DIGEST_SQL, digest, stays_plan
from checks.q_rows import BY_KIND, aware, by_kind, confirmed
from checks.registry import check, rounded
from pacecast.config import RunConfig
from pacecast.functions import arrays as A
from pacecast.operators import exclude, kept, results
from pacecast.operators.pace import KEYS
from pacecast.plans import inference, training
from pacecast.sources import sinks, tables

PERIODS = (date(1996, 6, 30), date(1996, 7, 1), date(1996, 7, 2), date(2100, 1, 1))


def recorded(v) -> str:
    """A folder of kept cells: a base, two days, all that came later; the second day is recorded twice.

    The bookings meet their orders and cancellations once, not once a period.
    """
    rows = aware(v).select(*KEYS, "confirmation_date", "cancellation_date", *kept.AMOUNTS[1:])
    path, rows, after = v.scratch("kept"), sinks.stage(rows, v.scratch("aware")), None
    for through in PERIODS:
        kept.record(kept.changes(rows, after, through), path, through)
        if through == PERIODS[2]:
            kept.record(kept.changes(rows, after, through), path, through)
        after = through
    return path


@check(
    "p01_kept_cells",
    "aware",
    """select HotelID, stay_date, cast(lead as int) as lead, cast(gone as int) as gone, count(*) as n,
         round(sum(revenue), 6) + 0.0 as revenue, round(sum(rooms), 6) + 0.0 as rooms from aware group by 1, 2, 3, 4""",
)
def p01_kept(v):
    """Base and increments, compacted half way, are what a rebuild from all bookings gives."""
    path, compacted = recorded(v), v.scratch("compacted")
    kept.compact(v.spark, path, PERIODS[1], compacted)
    return rounded(kept.state(v.spark, compacted), "revenue", "rooms")


@check(
    "p01_kept_cells_as_of",
    "aware",
    f"""select HotelID, stay_date, cast(lead as int) as lead, cast(case when gone >= 0
           and greatest(cancellation_date, confirmation_date) <= date '{PERIODS[2]}' then gone else -1 end as int) as gone,
         count(*) as n, round(sum(revenue), 6) + 0.0 as revenue, round(sum(rooms), 6) + 0.0 as rooms
       from aware where confirmation_date <= date '{PERIODS[2]}' group by 1, 2, 3, 4""",
)
def p01_as_of(v):
    """The state of an earlier day, when later cancellations were not known yet."""
    return rounded(kept.state(v.spark, recorded(v), PERIODS[2]), "revenue", "rooms")


@check(
    "p02_kept_targets",
    "confirmed",
    "select HotelID, stay_date, " + DIGEST_SQL.replace("amount", "revenue") + " from confirmed group by 1, 2",
)
def p02_kept(v):
    """The training plan's cells read from kept ones: the lasting pace of every stay."""
    config = RunConfig()
    stays = training.stays_from(kept.as_bookings(kept.state(v.spark, recorded(v))), config)
    lasting = A.pace_between(A.confirmed_cells(F.col("cells")), 0, config.lead_window)
    return stays.select("HotelID", "stay_date", lasting.alias("pace")).select("HotelID", "stay_date", *digest())


@check(
    "g01_footer_watermark",
    "bookings",
    f"""select HotelID, {BY_KIND} from bookings where confirmation_date = (select max(confirmation_date) from bookings)
        group by 1""",
)
def g01_footer(v):
    """The bookings of the latest day, which the footers of the written table name."""
    path = v.scratch("watermark")
    sinks.overwrite(v.bookings.select("HotelID", "confirmation_date", "revenue", "rooms"), path)
    latest = tables.footer_watermark(v.spark, path)
    found = tables.read_table(v.spark, path).withColumn("HotelID", F.col("HotelID").cast("string"))
    return by_kind(found.where(F.col("confirmation_date") == F.lit(latest)), "HotelID")


# A range for each stay with a booking that did not last, up to two days long: many overlap, touch and repeat.
MANY_SQL = """many as (select HotelID, stay_date as range_start,
    stay_date + cast(TransactionID % 3 as int) as range_end from bookings where status <> 'Confirmed')"""


def many_ranges(v):
    lost = v.bookings.where("status <> 'Confirmed'")
    end = F.date_add("stay_date", (F.col("TransactionID") % 3).cast("int"))
    return lost.select("HotelID", F.col("stay_date").alias("range_start"), end.alias("range_end"))


@check(
    "j07_merged_ranges",
    "bookings",
    "with " + MANY_SQL + """,
       r as (select HotelID, range_start, max(range_end) as range_end from many group by 1, 2),
       f as (select *, max(range_end) over (partition by HotelID order by range_start
         rows between unbounded preceding and 1 preceding) as reached from r),
       i as (select *, sum(case when reached is null or range_start > reached + 1 then 1 else 0 end)
         over (partition by HotelID order by range_start rows unbounded preceding) as island from f)
       select HotelID, min(range_start) as range_start, max(range_end) as range_end from i group by HotelID, island""",
)
def j07_merged(v):
    return exclude.merged_ranges(many_ranges(v))


@check(
    "j07_many_ranges",
    "bookings hotel_stays",
    "with " + MANY_SQL + """,
       days as (select distinct HotelID, range_start + cast(k as int) as stay_date
         from many cross join (select unnest(generate_series(0, 2)) as k) g where range_start + cast(k as int) <= range_end)
       select HotelID, stay_date from hotel_stays anti join days using (HotelID, stay_date)""",
)
def j07_many(v):
    return exclude.drop_excluded(v.hotel_stays, many_ranges(v))


@check(
    "m06_run_report",
    "confirmed hotel_config",
    f"""with s as (select distinct HotelID, stay_date, stay_date - date '{ORIGIN}' as d from confirmed
          join hotel_config using (HotelID)
          where stay_date > date '{ORIGIN}' and confirmation_date <= date '{ORIGIN}' and stay_date <= date '{ORIGIN}' + 28
            and stay_date - date '{ORIGIN}' <= inference_length),
        named as (select case when HotelID = '1' then '{results.NO_CURRENCY}' when d > 14 then '{results.NO_MODEL}'
            else '{results.DONE}' end as outcome from s),
        asked as (select unnest([{", ".join(f"'{r}'" for r in results.REASONS)}]) as outcome)
       select outcome, count(named.outcome) as paths from asked left join named using (outcome) group by 1""",
)
def m06_report(v):
    """Models reach 14 days, the forecast 28; one hotel has no currency. All counted while the rows are staged."""
    config = RunConfig(horizon=14, lags=())
    hotels = v.hotel_config.withColumn(
        "forecast_currency", F.when(F.col("HotelID") != "1", F.col("forecast_currency"))
    )
    params = training.train(stays_plan(v, ORIGIN, config), config)
    matrix = inference.inference_matrix(confirmed(v), config, hotels, ORIGIN)
    table = inference.forecast(matrix, params, config, "run1", datetime(2001, 6, 15), unfitted=True)
    counters = Observation()
    inference.publish(table, hotels, config, "run1", v.scratch("published"), v.scratch("staged"), counters)
    return results.run_report(v.spark, counters)
