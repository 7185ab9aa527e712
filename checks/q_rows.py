"""Scans, filters, joins and aggregates on bookings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.registry import check, r6, rounded
from pacecast.config import RunConfig
from pacecast.operators import clean, exclude, monitor, pace
from pacecast.plans import training
from pacecast.sources import tables

CONFIG = RunConfig()


def dated(v):
    kept = clean.preprocess(v.bookings)
    return clean.fill_no_show(clean.attach_cancellations(kept, v.transactions))


def confirmed(v):
    return training.confirmed_bookings(v.bookings, v.transactions, v.booking_status, CONFIG)


def aware(v):
    return training.aware_bookings(v.bookings, v.transactions, v.booking_status, CONFIG)


# Amounts have four decimals, so large sums are exact as decimals.
BY_KIND = """count(*) as n, cast(sum(cast(revenue as decimal(18, 4))) as double) as revenue,
 cast(sum(cast(rooms as decimal(18, 4))) as double) as rooms"""


def by_kind(df, *keys):
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(c).cast("decimal(18,4)")).cast("double").alias(c) for c in ("revenue", "rooms")],
    )


@check("a01_scan_bookings", "bookings", "select * from bookings")
def a01(v):
    return v.bookings


@check(
    "a02_confirmed_scan",
    "bookings",
    "select HotelID, stay_date, confirmation_date, revenue from bookings where status = 'Confirmed'",
)
def a02(v):
    return tables.confirmed_scan(v.bookings, ["HotelID", "stay_date", "confirmation_date", "revenue"])


@check(
    "a03_f19_hotel_dimension",
    "bookings hotel_config",
    """select distinct HotelID, substring(HotelName, 1, 20) as HotelName
       from bookings join hotel_config using (HotelID)""",
)
def a03(v):
    named = clean.attach_config(v.bookings.select("HotelID"), v.hotel_config, "HotelName")
    return tables.short_name(tables.hotel_dimension(named))


@check(
    "a04_j06_status_semi_join",
    "bookings booking_status",
    f"""select HotelID, status, {BY_KIND} from bookings
        where status in (select status from booking_status where scenario = 'cancelled') group by HotelID, status""",
)
def a04(v):
    rows = v.bookings.join(tables.statuses(v.booking_status, "cancelled"), "status", "left_semi")
    return by_kind(rows, "HotelID", "status")


@check(
    "f01_f03_select_rename_constant",
    "bookings",
    """select HotelID as hotel, stay_date as night, revenue, false as pms_sync_off, 'REVENUE' as target_type
       from bookings""",
)
def f01(v):
    picked = v.bookings.select("HotelID", "stay_date", "revenue")
    renamed = picked.withColumnsRenamed({"HotelID": "hotel", "stay_date": "night"})
    return renamed.withColumns({"pms_sync_off": F.lit(False), "target_type": F.lit("REVENUE")})


CONFIRMED_COLUMNS = "TransactionID, HotelID, stay_date, confirmation_date, cancellation_date, status, revenue, rooms"


@check("f05_confirmed_only", "confirmed", f"select {CONFIRMED_COLUMNS} from confirmed")
def f05(v):
    return confirmed(v).select(*CONFIRMED_COLUMNS.split(", "))


@check("f06_cancel_aware", "aware", f"select {CONFIRMED_COLUMNS} from aware")
def f06(v):
    return aware(v).select(*CONFIRMED_COLUMNS.split(", "))


@check(
    "f07_no_show_fill",
    "bookings transactions",
    f"""with j as (select b.*, t.cancellation_date from bookings b left join transactions t using (TransactionID)),
      m as (select 'fill_null' as mode, j.* replace (case when status = 'No-show' and cancellation_date is null
              then stay_date else cancellation_date end as cancellation_date) from j
            union all
            select 'overwrite', j.* replace (case when status = 'No-show' then stay_date
              else cancellation_date end as cancellation_date) from j)
      select mode, status, cancellation_date is null as open, {BY_KIND} from m group by mode, status, 3""",
)
def f07(v):
    joined = clean.attach_cancellations(v.bookings, v.transactions)
    modes = [
        by_kind(
            clean.fill_no_show(joined, mode).withColumn("open", F.col("cancellation_date").isNull()), "status", "open"
        ).withColumn("mode", F.lit(mode))
        for mode in ("fill_null", "overwrite")
    ]
    return modes[0].unionByName(modes[1])


@check(
    "f08_f09_dates",
    "",
    """select o_orderkey, cast(o_orderdate as date) as day,
              cast(epoch(date_trunc('day', o_orderdate)) as bigint) as seconds from orders""",
)
def f08(v):
    orders = v.spark.read.parquet(f"{v.sf_dir}/orders.parquet")
    days = clean.normalise_dates(orders.select("o_orderkey", F.col("o_orderdate").alias("day")), "day")
    parsed = clean.parse_timestamp(days.withColumn("text", F.col("day").cast("string")), "text")
    return parsed.select("o_orderkey", "day", F.unix_timestamp("text").alias("seconds"))


@check(
    "f10_select_hotels",
    "bookings hotel_config",
    f"""select HotelID, {BY_KIND} from bookings
        where HotelID in (select HotelID from hotel_config where Country = 'US') group by HotelID""",
)
def f10(v):
    return by_kind(clean.select_hotels(v.bookings, v.hotel_config.where("Country = 'US'")), "HotelID")


@check(
    "f11_f13_preprocess_cuts",
    "bookings",
    f"""select HotelID, channel, {BY_KIND}, min(stay_date) as first_stay from bookings
        where stay_date >= date '1996-01-01' and channel <> 'PMS' and confirmation_date <= stay_date
          and not (stay_date between date '1998-03-01' and date '1998-08-01') group by HotelID, channel""",
)
def f11(v):
    cut = clean.preprocess(
        v.bookings, date(1996, 1, 1), without_pms=True, closed_window=(date(1998, 3, 1), date(1998, 8, 1))
    )
    return by_kind(cut, "HotelID", "channel").join(
        cut.groupBy("HotelID", "channel").agg(F.min("stay_date").alias("first_stay")), ["HotelID", "channel"]
    )


@check(
    "f14_train_cut",
    "bookings",
    f"""select HotelID, {BY_KIND} from bookings
        where stay_date <= (select max(confirmation_date) from bookings) group by HotelID""",
)
def f14(v):
    return by_kind(clean.train_cut(v.bookings, clean.watermark(v.bookings)), "HotelID")


@check(
    "f15_test_window",
    "bookings",
    """select HotelID, stay_date, confirmation_date, revenue, rooms from bookings
       where stay_date > date '2000-03-01' and stay_date <= date '2000-03-29'
         and confirmation_date <= date '2000-03-01'""",
)
def f15(v):
    window = clean.test_window(v.bookings, date(2000, 3, 1), date(2000, 3, 29))
    return window.select("HotelID", "stay_date", "confirmation_date", "revenue", "rooms")


@check(
    "f17_f18_region_clean",
    "bookings hotel_config",
    f"""with h as (select HotelID, case when Country in ('US','CA') then State else 'N/A' end as State
                   from hotel_config where HotelID is not null)
        select h.State, {BY_KIND} from bookings join h using (HotelID) group by h.State""",
)
def f17(v):
    cleaned = tables.clean_hotels(v.hotel_config)
    return by_kind(clean.attach_config(v.bookings, cleaned, "State"), "State")


@check(
    "g01_g02_inference_window",
    "bookings hotel_config",
    """select max(confirmation_date) as partition_date,
              max(confirmation_date) + (select max(inference_length) from hotel_config) as partition_end,
              (select max(lead_window) from hotel_config) as max_lead_window from bookings""",
)
def g01(v):
    longest = v.hotel_config.agg(F.max("inference_length")).scalar()
    widest = v.hotel_config.agg(F.max("lead_window")).scalar()
    return v.bookings.agg(F.max("confirmation_date").alias("partition_date")).select(
        "partition_date",
        F.date_add("partition_date", longest).alias("partition_end"),
        widest.alias("max_lead_window"),
    )


@check("g03_distinct_keys", "bookings", "select distinct HotelID, stay_date from bookings")
def g03(v):
    return v.bookings.select("HotelID", "stay_date").distinct()


@check(
    "g04_w01_daily_net",
    "confirmed",
    """select HotelID, stay_date, confirmation_date, round(sum(revenue), 6) + 0.0 as revenue,
              round(sum(rooms), 6) + 0.0 as rooms from confirmed group by 1, 2, 3""",
)
def g04(v):
    return rounded(clean.daily_net(confirmed(v)), "revenue", "rooms")


@check(
    "g04_daily_net_cancel_aware",
    "aware",
    """select HotelID, stay_date, confirmation_date, cancellation_date, round(sum(revenue), 6) + 0.0 as revenue,
              round(sum(rooms), 6) + 0.0 as rooms from aware group by 1, 2, 3, 4""",
)
def g04_aware(v):
    return rounded(clean.daily_net(aware(v), with_cancellation=True), "revenue", "rooms")


@check(
    "g05_forecast_origin",
    "forecasts",
    """select pms_sync_off, run_date, HotelID, stay_date, min(booking_date) as eval_start_date
       from forecasts group by 1, 2, 3, 4""",
)
def g05(v):
    return v.forecasts.groupBy("pms_sync_off", "run_date", "HotelID", "stay_date").agg(F.min("booking_date").alias("eval_start_date"))


@check(
    "g06_w05_latest_exclusions",
    "bookings exclusions",
    """select e.HotelID, e.ts, e.range_start, e.range_end, count(b.stay_date) as bookings_inside
       from exclusions e left join bookings b on b.HotelID = e.HotelID and b.stay_date between range_start and range_end
       where e.pipeline = 'main_training_pipeline'
         and e.ts = (select max(ts) from exclusions x
                     where x.pipeline = 'main_training_pipeline' and x.HotelID = e.HotelID)
       group by 1, 2, 3, 4""",
)
def g06(v):
    latest = exclude.latest_config(tables.exclusion_scan(v.exclusions, "main_training_pipeline"))
    days = v.bookings.groupBy("HotelID", "stay_date").agg(F.count("*").alias("n"))
    inside = F.col("stay_date").between(F.col("range_start"), F.col("range_end"))
    hit = latest.alias("e").join(days.alias("b"), (F.col("e.HotelID") == F.col("b.HotelID")) & inside, "left")
    return hit.groupBy("e.HotelID", "ts", "range_start", "range_end").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("bookings_inside")
    )


@check(
    "j01_attach_cancellations",
    "bookings transactions",
    f"""select b.status, case when t.cancellation_date is null then 'open'
              when t.cancellation_date <= b.stay_date then 'before' else 'after' end as kind, {BY_KIND}
        from bookings b left join transactions t using (TransactionID) group by 1, 2""",
)
def j01(v):
    joined = clean.attach_cancellations(v.bookings, v.transactions)
    kind = (
        F.when(F.col("cancellation_date").isNull(), "open")
        .when(F.col("cancellation_date") <= F.col("stay_date"), "before")
        .otherwise("after")
    )
    return by_kind(joined.withColumn("kind", kind), "status", "kind")


@check(
    "j01_candidates_only",
    "bookings transactions",
    f"""select b.status, case when t.cancellation_date is null then 'open'
              when t.cancellation_date <= b.stay_date then 'before' else 'after' end as kind, {BY_KIND}
        from bookings b left join transactions t using (TransactionID) group by 1, 2""",
)
def j01_candidates(v):
    """Only bookings that a filter of cancelled ids lets through meet the transactions."""
    joined = clean.attach_to_candidates(v.bookings, v.transactions, bits=1 << 24)
    kind = (
        F.when(F.col("cancellation_date").isNull(), "open")
        .when(F.col("cancellation_date") <= F.col("stay_date"), "before")
        .otherwise("after")
    )
    return by_kind(joined.withColumn("kind", kind), "status", "kind")


@check(
    "j07_drop_excluded",
    "hotel_stays exclusions",
    """with e as (select * from exclusions where pipeline = 'main_training_pipeline'),
       l as (select * from e where ts = (select max(ts) from e x where x.HotelID = e.HotelID))
       select HotelID, stay_date from hotel_stays s where not exists
         (select 1 from l where l.HotelID = s.HotelID and s.stay_date between l.range_start and l.range_end)""",
)
def j07(v):
    latest = exclude.latest_config(tables.exclusion_scan(v.exclusions, "main_training_pipeline"))
    return exclude.drop_excluded(v.hotel_stays, latest)


@check(
    "j08_w03_partition_minimum",
    "forecasts",
    """select HotelID, stay_date, booking_date, day_index,
              min(booking_date) over (partition by pms_sync_off, run_date, HotelID, stay_date) as origin_date
       from forecasts qualify booking_date > origin_date""",
)
def j08(v):
    return monitor.align(v.forecasts, "run_date").select(
        "HotelID", "stay_date", F.col("confirmation_date").alias("booking_date"), "day_index", "origin_date"
    )


@check(
    "j10_attach_config",
    "bookings hotel_config",
    """select HotelID, available_rooms, forecast_currency, count(*) as n,
              round(sum(rooms) / max(available_rooms), 6) + 0.0 as load
       from bookings join hotel_config using (HotelID) group by 1, 2, 3""",
)
def j10(v):
    rows = clean.attach_config(v.bookings, v.hotel_config, "available_rooms", "forecast_currency")
    return rows.groupBy("HotelID", "available_rooms", "forecast_currency").agg(
        F.count("*").alias("n"), r6(F.sum("rooms") / F.max("available_rooms")).alias("load")
    )


@check(
    "s01_sorted_daily_net",
    "confirmed",
    """select HotelID, stay_date, count(distinct confirmation_date) as days, round(sum(revenue), 6) + 0.0 as revenue
       from confirmed group by 1, 2 order by 1, 2""",
)
def s01(v):
    daily = clean.daily_net(confirmed(v)).groupBy(*pace.KEYS)
    return rounded(daily.agg(F.count("*").alias("days"), F.sum("revenue").alias("revenue")), "revenue").orderBy(*pace.KEYS)


@check(
    "r03_deduplicate",
    "bookings",
    "select distinct HotelID, stay_date, confirmation_date from bookings",
)
def r03(v):
    return v.bookings.select("HotelID", "stay_date", "confirmation_date").dropDuplicates()


@check(
    "w02_running_total",
    "confirmed",
    """with d as (select HotelID, stay_date, confirmation_date, sum(revenue) as revenue from confirmed group by 1, 2, 3)
       select HotelID, stay_date, confirmation_date, cast(stay_date - confirmation_date as int) as booking_lead,
              round(sum(revenue) over (partition by HotelID, stay_date order by confirmation_date
                                       rows unbounded preceding), 6) + 0.0 as cum_sum_value from d""",
)
def w02(v):
    return rounded(pace.running_total(clean.daily_net(confirmed(v)), "revenue"), "cum_sum_value")
