"""Booking-pace arrays, snapshots, calendar, lags and the training matrix."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.q_rows import CONFIG, aware, confirmed
from checks.registry import check, r6, rounded
from pacecast.config import RunConfig
from pacecast.functions.dates import CALENDAR_FEATURES
from pacecast.operators import features, pace
from pacecast.plans import training
from pacecast.sources import tables

LEADS, SNAPSHOTS = CONFIG.lead_window, CONFIG.snapshots

# A snapshot's 100 slots, checked by their sum, their weighted sum and single slots.
DIGEST_SQL = """round(sum(amount * least(lead + 1, {L})), 4) + 0.0 as slot_sum,
 round(sum(amount * least(lead + 1, {L}) * (least(lead + 1, {L}) + 1) / 2), 4) + 0.0 as slot_weighted,
 round(sum(amount), 6) + 0.0 as slot_0, round(sum(case when lead >= 28 then amount else 0 end), 6) + 0.0 as slot_28,
 round(sum(case when lead >= {L} - 1 then amount else 0 end), 6) + 0.0 as slot_last""".format(L=LEADS)


def digest(column: str = "pace"):
    total = F.aggregate(column, F.lit(0.0), lambda a, x: a + x)
    weighted = F.aggregate(
        F.transform(column, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x
    )
    return [
        (F.round(total, 4) + F.lit(0.0)).alias("slot_sum"),
        (F.round(weighted, 4) + F.lit(0.0)).alias("slot_weighted"),
        r6(F.get(column, F.lit(0))).alias("slot_0"),
        r6(F.get(column, F.lit(28))).alias("slot_28"),
        r6(F.get(column, F.lit(LEADS - 1))).alias("slot_last"),
    ]


def slots(df, column: str):
    return df.select(*pace.KEYS, F.posexplode_outer(column).alias("lead", "value")).withColumn("value", r6("value"))


def holidays(v, first, last):
    """New Year and Christmas in every region, Independence Day in the US, over the booked span."""
    regions = tables.clean_hotels(v.hotel_config).select("Country", "State").distinct()
    days = regions.select("Country", "State", F.explode(F.sequence(first, last)).alias("date"))
    day = F.date_format("date", "MM-dd")
    off = day.isin("01-01", "12-25") | ((day == "07-04") & (F.col("Country") == "US"))
    return days.where(off).select("date", "Country", "State", day.alias("name"))


def booked_span(v):
    ends = v.bookings.agg(F.min("stay_date").alias("a"), F.max("stay_date").alias("b"))
    return ends.select("a").scalar(), ends.select("b").scalar()


def calendar(v):
    hotels = tables.clean_hotels(v.hotel_config)
    first, last = booked_span(v)
    days = features.region_calendar(hotels, first, last, holidays(v, first, last))
    return features.hotel_calendar(days, hotels)


CALENDAR_SQL = """
bounds as (select min(stay_date) as a, max(stay_date) as b from bookings),
days as (select cast(unnest(generate_series(a, b, interval 1 day)) as date) as d from bounds),
cal as (select h.HotelID, d as stay_date, h.Country,
  case when h.Country in ('US','CA') then h.State else 'N/A' end as State,
  cast(year(d) as int) as year, cast(quarter(d) as int) as quarter_of_year, cast(month(d) as int) as month_of_year,
  cast(weekofyear(d) as int) as week_of_year, cast(dayofyear(d) as int) as day_of_year,
  cast((month(d) - 1) % 3 + 1 as int) as month_of_quarter,
  cast((d - cast(date_trunc('quarter', d) as date)) // 7 + 1 as int) as week_of_quarter,
  cast(d - cast(date_trunc('quarter', d) as date) + 1 as int) as day_of_quarter,
  cast((day(d) - 1) // 7 + 1 as int) as week_of_month, cast(day(d) as int) as day_of_month,
  case when strftime(d, '%m-%d') in ('01-01', '12-25') or (strftime(d, '%m-%d') = '07-04' and h.Country = 'US')
    then 1 else 0 end as holiday,
""" + ",\n".join(f"  case when isodow(d) = {i + 1} then 1 else 0 end as day_of_week_{i}" for i in range(7)) + """
 from days cross join hotel_config h where h.Country is not null)"""

FEATURE_LIST = ", ".join(CALENDAR_FEATURES)

LAGS_SQL = """
totals as (select HotelID, stay_date, sum(revenue) as total from confirmed group by 1, 2),
sent as (select HotelID, stay_date + n as stay_date, n, total from totals
         cross join (values (1), (7), (14), (28)) k(n)),
lags as (select HotelID, stay_date, max(case when n = 1 then total end) as lag1,
  max(case when n = 7 then total end) as lag7, max(case when n = 14 then total end) as lag14,
  max(case when n = 28 then total end) as lag28 from sent group by 1, 2)"""


@check(
    "p01_pace",
    "confirmed hotel_config",
    """select HotelID, substring(HotelName, 1, 20) as HotelName, stay_date,
         round(sum(case when lead >= 28 then revenue else 0 end), 6) + 0.0 as booked_28,
         round(sum(case when lead >= 14 then revenue else 0 end), 6) + 0.0 as booked_14,
         round(sum(case when lead >= 7 then revenue else 0 end), 6) + 0.0 as booked_7,
         round(sum(revenue), 6) + 0.0 as booked_0
       from confirmed join hotel_config using (HotelID) group by 1, 2, 3""",
)
def p01(v):
    curve = pace.pace(confirmed(v), "revenue", LEADS)
    named = curve.join(tables.short_name(v.hotel_config).select("HotelID", "HotelName"), "HotelID")
    slot = [r6(F.get("pace", F.lit(i))).alias(f"booked_{i}") for i in (28, 14, 7, 0)]
    return named.select("HotelID", "HotelName", "stay_date", *slot).orderBy("HotelID", "stay_date")


@check(
    "p01_pace_slots",
    "confirmed",
    f"""select s.HotelID, s.stay_date, cast(l.l as int) as lead,
          round(sum(case when lead >= l.l then revenue else 0 end), 6) + 0.0 as value
        from confirmed s cross join (select unnest(generate_series(0, {LEADS - 1})) as l) l group by 1, 2, 3""",
)
def p01_slots(v):
    return slots(pace.pace(confirmed(v), "revenue", LEADS), "pace")


@check(
    "p02_target_pace",
    "confirmed",
    """select s.HotelID, s.stay_date, cast(l.l as int) as lead,
          round(sum(case when lead >= l.l then rooms else 0 end), 6) + 0.0 as value
        from confirmed s cross join (select unnest(generate_series(0, 27)) as l) l group by 1, 2, 3""",
)
def p02(v):
    return slots(pace.target_pace(confirmed(v), "rooms", CONFIG.horizon), "target")


@check(
    "p03_cancel_aware_snapshots",
    "aware",
    f"""select HotelID, stay_date, cast(k as int) as forecast_index, {DIGEST_SQL}
        from (select HotelID, stay_date, lead, k, case when gone < k then revenue else 0 end as amount
              from aware cross join (select unnest(generate_series(0, {SNAPSHOTS - 1})) as k) s) group by 1, 2, 3""",
)
def p03(v):
    found = pace.snapshot_pace(aware(v), "revenue", LEADS, SNAPSHOTS)
    return found.select(*pace.KEYS, "forecast_index", *digest())


@check(
    "p05_j12_lags",
    "confirmed",
    "with " + LAGS_SQL.strip() + """
       select HotelID, stay_date, round(lag1, 6) + 0.0 as lag1, round(lag7, 6) + 0.0 as lag7,
         round(lag14, 6) + 0.0 as lag14, round(lag28, 6) + 0.0 as lag28 from lags""",
)
def p05(v):
    totals = confirmed(v).groupBy(*pace.KEYS).agg(F.sum("revenue").alias("total"))
    return rounded(features.lag_totals(totals, "total", CONFIG.lags), "lag1", "lag7", "lag14", "lag28")


@check(
    "p05_far_field_lags",
    "confirmed",
    """with totals as (select HotelID, stay_date, sum(rooms) as total from confirmed group by 1, 2),
       sent as (select HotelID, stay_date + cast(n as int) as stay_date, n, total from totals
                cross join (select unnest(generate_series(7, 147, 7)) as n) k)
       select HotelID, stay_date, round(sum(total), 6) + 0.0 as lag_sum, count(*) as lags_known,
         max(case when n = 147 then total end) + 0.0 as lag147 from sent group by 1, 2""",
)
def p05_far(v):
    from pacecast.config import FarFieldConfig

    lags = FarFieldConfig().lags
    totals = confirmed(v).groupBy(*pace.KEYS).agg(F.sum("rooms").alias("total"))
    wide = features.lag_totals(totals, "total", lags)
    known = F.array_compact(F.array(*[f"lag{n}" for n in lags]))
    return wide.select(
        *pace.KEYS,
        r6(F.aggregate(known, F.lit(0.0), lambda a, x: a + x)).alias("lag_sum"),
        F.size(known).cast("bigint").alias("lags_known"),
        "lag147",
    )


@check(
    "p06_j02_calendar",
    "bookings hotel_config",
    "with " + CALENDAR_SQL.strip() + f" select HotelID, Country, State, stay_date, {FEATURE_LIST} from cal",
)
def p06(v):
    return calendar(v).select("HotelID", "Country", "State", "stay_date", *CALENDAR_FEATURES)


@check(
    "a05_calendar_scan",
    "bookings hotel_config",
    "with " + CALENDAR_SQL.strip() + """ select HotelID, stay_date, holiday, week_of_year from cal
       where stay_date between date '1999-01-01' and date '1999-12-31'""",
)
def a05(v):
    bounded = tables.calendar_scan(calendar(v), date(1999, 1, 1), date(1999, 12, 31))
    return bounded.select("HotelID", "stay_date", "holiday", "week_of_year")


@check(
    "p07_days_ahead",
    "bookings",
    """select HotelID, stay_date, cast(stay_date - (select max(confirmation_date) from bookings) as int) as day_ahead,
              count(*) as n from bookings group by 1, 2""",
)
def p07(v):
    stays = v.bookings.groupBy(*pace.KEYS).agg(F.count("*").alias("n"))
    wm = v.bookings.agg(F.max("confirmation_date")).scalar()
    return features.days_ahead(stays, wm)


def stays_plan(v, partition_date=None, config=CONFIG, calendar_features=False, with_features=True):
    hotels = tables.clean_hotels(v.hotel_config) if calendar_features else None
    days_off = holidays(v, *booked_span(v)) if calendar_features else None
    return training.training_stays(
        v.bookings, v.transactions, v.booking_status, config, hotels, days_off, v.exclusions, partition_date, with_features
    )


KEPT_SQL = """
e as (select * from exclusions where pipeline = 'main_training_pipeline'),
latest as (select * from e where ts = (select max(ts) from e x where x.HotelID = e.HotelID)),
kept as (select HotelID, stay_date from (select distinct HotelID, stay_date from confirmed) s
  where stay_date <= {cut} and not exists
    (select 1 from latest l where l.HotelID = s.HotelID and s.stay_date between l.range_start and l.range_end))"""


@check(
    "p04_j03_j04_training_matrix",
    "confirmed aware exclusions hotel_config",
    "with " + KEPT_SQL.format(cut="(select max(confirmation_date) from bookings)").strip() + "," + CALENDAR_SQL + "," + LAGS_SQL
    + f""",
       feats as (select HotelID, stay_date, cast(k as int) as forecast_index, {DIGEST_SQL}
         from (select HotelID, stay_date, lead, k, case when gone < k then revenue else 0 end as amount
               from aware cross join (select unnest(generate_series(0, {SNAPSHOTS - 1})) as k) s) group by 1, 2, 3),
       tgts as (select HotelID, stay_date, round(sum(revenue), 6) + 0.0 as tgt_0,
         round(sum(case when lead >= 27 then revenue else 0 end), 6) + 0.0 as tgt_27 from confirmed group by 1, 2)
       select f.*, tgt_0, tgt_27, round(lag7, 6) + 0.0 as lag7, round(lag28, 6) + 0.0 as lag28,
         day_of_quarter, holiday
       from kept join feats f using (HotelID, stay_date) join tgts using (HotelID, stay_date)
       left join lags using (HotelID, stay_date) left join cal using (HotelID, stay_date)""",
)
def p04(v):
    matrix = training.training_matrix(stays_plan(v, calendar_features=True), CONFIG)
    return matrix.select(
        *pace.KEYS,
        "forecast_index",
        *digest(),
        r6(F.get("target", F.lit(0))).alias("tgt_0"),
        r6(F.get("target", F.lit(27))).alias("tgt_27"),
        r6("lag7").alias("lag7"),
        r6("lag28").alias("lag28"),
        "day_of_quarter",
        "holiday",
    )


@check(
    "j03_targets_join_features",
    "confirmed aware",
    f"""select HotelID, stay_date, cast(k as int) as forecast_index, tgt_0, {DIGEST_SQL}
        from (select HotelID, stay_date, lead, k, case when gone < k then rooms else 0 end as amount
              from aware cross join (select unnest(generate_series(0, 27)) as k) s)
        join (select HotelID, stay_date, round(sum(rooms), 6) + 0.0 as tgt_0 from confirmed group by 1, 2) t
          using (HotelID, stay_date)
        group by 1, 2, 3, 4""",
)
def j03(v):
    targets = pace.target_pace(confirmed(v), "rooms", CONFIG.horizon)
    joined = pace.join_targets(targets, pace.snapshot_pace(aware(v), "rooms", LEADS, SNAPSHOTS))
    return joined.select(
        *pace.KEYS, "forecast_index", r6(F.get("target", F.lit(0))).alias("tgt_0"), *digest()
    )


@check(
    "p08_near_field_rows",
    "confirmed aware",
    "with " + LAGS_SQL.strip() + f""",
       b as (select HotelID, stay_date, d, sum(case when lead >= d and gone < d - 1 then revenue else 0 end) as base,
               sum(case when lead >= d and gone < d - 1 then revenue * (least(lead, {LEADS - 1}) - d + 1) else 0 end) as seen
             from aware cross join (select unnest(generate_series(1, 28)) as d) k group by 1, 2, 3),
       t as (select HotelID, stay_date, d, sum(case when lead >= d - 1 then revenue else 0 end) as tgt_first,
               sum(revenue) as tgt_last
             from confirmed cross join (select unnest(generate_series(1, 28)) as d) k group by 1, 2, 3)
       select HotelID, stay_date, cast(d as int) as day_ahead, round(base, 6) + 0.0 as base,
         round(tgt_first, 6) + 0.0 as tgt_first, round(tgt_last, 6) + 0.0 as tgt_last, cast(d as int) as n_targets,
         round(seen, 4) + 0.0 as seen,
         round(case when d < 7 then coalesce(lag7, 0) else 0 end + case when d < 14 then coalesce(lag14, 0) else 0 end
             + case when d < 28 then coalesce(lag28, 0) else 0 end, 4) + 0.0 as lag_sum,
         cast({LEADS} - d + case when d < 7 then 3 when d < 14 then 2 when d < 28 then 1 else 0 end as int) as n_features
       from b join t using (HotelID, stay_date, d) left join lags using (HotelID, stay_date)""",
)
def p08(v):
    stays = training.stays_from(aware(v), CONFIG)
    lagged = stays.join(
        features.lag_totals(stays.select(*pace.KEYS, "total"), "total", CONFIG.lags), list(pace.KEYS), "left"
    )
    rows = features.near_field_rows(training.training_matrix(lagged, CONFIG), 28, CONFIG.lags)
    d, total = F.col("day_ahead"), lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        *pace.KEYS,
        "day_ahead",
        r6("base").alias("base"),
        r6(F.get("y", F.lit(0))).alias("tgt_first"),
        r6(F.element_at("y", -1)).alias("tgt_last"),
        F.size("y").alias("n_targets"),
        (F.round(total(F.slice("x", F.lit(1), LEADS - d)), 4) + F.lit(0.0)).alias("seen"),
        (F.round(total(F.slice("x", LEADS - d + 1, F.size("x"))), 4) + F.lit(0.0)).alias("lag_sum"),
        F.size("x").alias("n_features"),
    )


@check(
    "p09_far_field_rows",
    "confirmed aware",
    """select HotelID, stay_date, cast(p as int) as day_ahead,
         round(sum(case when lead >= p and gone < p then revenue else 0 end), 6) + 0.0 as base,
         round(sum(case when gone = -1 and lead >= p - 7 then revenue else 0 end), 6) + 0.0 as target,
         round(sum(case when lead >= p and gone < p then revenue * (least(lead, 151) - p + 1) else 0 end), 4) + 0.0 as seen,
         cast(152 - p as int) as n_features
       from aware cross join (select unnest(generate_series(35, 91, 7)) as p) k
       where exists (select 1 from confirmed c where c.HotelID = aware.HotelID and c.stay_date = aware.stay_date)
       group by HotelID, stay_date, p""",
)
def p09(v):
    from pacecast.config import FarFieldConfig

    config = FarFieldConfig(lags=())
    rows = training.model_rows(training.stays_from(aware(v), config), config)
    total = F.aggregate("x", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        *pace.KEYS,
        "day_ahead",
        r6("base").alias("base"),
        r6(F.get("y", F.lit(0))).alias("target"),
        (F.round(total, 4) + F.lit(0.0)).alias("seen"),
        F.size("x").alias("n_features"),
    )


@check(
    "p09_reference_statuses",
    "dated aware",
    """with points as (select unnest(generate_series(35, 91, 7)) as p),
       tgts as (select HotelID, stay_date, p,
           sum(case when stay_date - confirmation_date >= p - 7 then revenue else 0 end) as target
         from dated cross join points
         where status in (select status from booking_status where scenario = 'confirmed') group by 1, 2, 3),
       feats as (select HotelID, stay_date, p, sum(case when lead >= p and gone < p then revenue else 0 end) as base,
           sum(case when lead >= p and gone < p then revenue * (least(lead, 151) - p + 1) else 0 end) as seen
         from aware cross join points group by 1, 2, 3)
       select HotelID, stay_date, cast(p as int) as day_ahead, round(base, 6) + 0.0 as base,
         round(target, 6) + 0.0 as target, round(seen, 4) + 0.0 as seen, cast(152 - p as int) as n_features
       from feats join tgts using (HotelID, stay_date, p)""",
)
def p09_statuses(v):
    """Targets by status alone, whatever the cancellation date says; features as ever."""
    from pacecast.config import FarFieldConfig

    config = FarFieldConfig(lags=(), targets_by_status=True)
    kept = training.aware_bookings(v.bookings, v.transactions, v.booking_status, config)
    rows = training.model_rows(training.stays_from(kept, config), config)
    total = F.aggregate("x", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        *pace.KEYS,
        "day_ahead",
        r6("base").alias("base"),
        r6(F.get("y", F.lit(0))).alias("target"),
        (F.round(total, 4) + F.lit(0.0)).alias("seen"),
        F.size("x").alias("n_features"),
    )


@check(
    "p09_far_field_lags",
    "confirmed",
    """with totals as (select HotelID, stay_date, sum(revenue) as total from confirmed group by 1, 2),
       points as (select unnest(generate_series(35, 91, 7)) as p), ns as (select unnest(generate_series(7, 147, 7)) as n)
       select k.HotelID, k.stay_date, cast(p as int) as day_ahead, round(coalesce(sum(t.total), 0), 4) + 0.0 as lag_sum,
         cast(152 - p + count(*) as int) as n_features
       from totals k cross join points join ns on n > p
       left join totals t on t.HotelID = k.HotelID and t.stay_date = k.stay_date - cast(n as int)
       group by k.HotelID, k.stay_date, p""",
)
def p09_lags(v):
    """Far points see the lags longer than their distance alone."""
    from pacecast.config import FarFieldConfig

    config = FarFieldConfig()
    stays = training.stays_from(aware(v), config)
    lagged = features.lag_totals(stays.select(*pace.KEYS, "total"), "total", config.lags)
    rows = training.model_rows(stays.join(lagged, list(pace.KEYS), "left"), config)
    own = F.slice("x", config.lead_window - F.col("day_ahead") + 1, F.size("x"))
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        *pace.KEYS, "day_ahead", (F.round(total, 4) + F.lit(0.0)).alias("lag_sum"), F.size("x").alias("n_features")
    )


@check(
    "p08_long_horizon",
    "confirmed aware",
    """with b as (select HotelID, stay_date, d, sum(case when lead >= d and gone < d - 1 then revenue else 0 end) as base
             from aware cross join (select unnest(generate_series(1, 40)) as d) k group by 1, 2, 3),
       t as (select HotelID, stay_date, d, sum(case when lead >= d - 1 then revenue else 0 end) as tgt_first
             from confirmed cross join (select unnest(generate_series(1, 40)) as d) k group by 1, 2, 3)
       select HotelID, stay_date, cast(d as int) as day_ahead, round(base, 6) + 0.0 as base,
         round(tgt_first, 6) + 0.0 as tgt_first, cast(d as int) as n_targets from b join t using (HotelID, stay_date, d)""",
)
def p08_long(v):
    config = RunConfig(horizon=40, lags=())
    rows = training.model_rows(training.stays_from(aware(v), config), config)
    return rows.select(
        *pace.KEYS, "day_ahead", r6("base").alias("base"), r6(F.get("y", F.lit(0))).alias("tgt_first"), F.size("y").alias("n_targets")
    )


@check(
    "j07_f10_plan_cuts",
    "confirmed exclusions",
    "with " + KEPT_SQL.format(cut="date '2001-06-15'").strip() + """
       select HotelID, stay_date, cast(count(*) as bigint) as n from kept where HotelID in ('0', '2') group by 1, 2""",
)
def j07_plan(v):
    """The plan itself takes raw exclusions (other pipelines' ranges among them) and the hotels asked for."""
    asked = v.hotel_config.where(F.col("HotelID").isin("0", "2")).select("HotelID")
    stays = training.training_stays(
        v.bookings, v.transactions, v.booking_status, CONFIG, exclusions=v.exclusions, partition_date=date(2001, 6, 15),
        with_features=False, requested=asked,
    )
    return stays.groupBy(*pace.KEYS).agg(F.count("*").alias("n"))


@check(
    "p10_horizon_split",
    "confirmed",
    """with s as (select HotelID, stay_date, sum(revenue) as revenue from confirmed group by 1, 2),
       m as (select *, max(stay_date) over (partition by HotelID) as last from s)
       select HotelID, stay_date, last - 28 as test_start, last as test_end, stay_date >= last - 28 as is_test,
              round(revenue, 6) + 0.0 as revenue from m""",
)
def p10(v):
    stays = confirmed(v).groupBy(*pace.KEYS).agg(F.sum("revenue").alias("revenue"))
    return rounded(features.horizon_split(stays, 28), "revenue")


@check(
    "p10_per_hotel_length",
    "confirmed hotel_config",
    """with s as (select HotelID, stay_date, sum(revenue) as revenue from confirmed group by 1, 2),
       m as (select s.*, max(stay_date) over (partition by s.HotelID) as last,
               case when HotelID <> '3' then cast(inference_length as int) else 28 end as days from s left join hotel_config using (HotelID))
       select HotelID, stay_date, last - days as test_start, last as test_end, stay_date >= last - days as is_test,
              round(revenue, 6) + 0.0 as revenue from m""",
)
def p10_lengths(v):
    """Hotels with a training length of their own, and one without."""
    stays = confirmed(v).groupBy(*pace.KEYS).agg(F.sum("revenue").alias("revenue"))
    own = v.hotel_config.where("HotelID <> '3'").withColumnRenamed("inference_length", "training_length")
    return rounded(features.horizon_split(stays, 28, own), "revenue")


@check(
    "p08_plain_rows",
    "confirmed",
    """with b as (select HotelID, stay_date, d, sum(case when lead >= d then revenue else 0 end) as base,
               sum(case when lead >= d - 1 then revenue else 0 end) as tgt_first
             from confirmed cross join (select unnest(generate_series(1, 28)) as d) k group by 1, 2, 3)
       select HotelID, stay_date, cast(d as int) as day_ahead, round(base, 6) + 0.0 as base,
         round(tgt_first, 6) + 0.0 as tgt_first from b where stay_date <= date '2001-06-15'""",
)
def p08_plain(v):
    """Training without cancellations: every distance reads the plain pace."""
    config = RunConfig(cancel_aware=False, lags=())
    stays = training.training_stays(
        v.bookings, v.transactions, v.booking_status, config, partition_date=date(2001, 6, 15), with_features=False
    )
    rows = training.model_rows(stays, config)
    return rows.select(*pace.KEYS, "day_ahead", r6("base").alias("base"), r6(F.get("y", F.lit(0))).alias("tgt_first"))


@check(
    "p11_adr_pace",
    "confirmed",
    f"""select HotelID, stay_date, cast(l as int) as lead,
          round(sum(case when lead >= l then revenue else 0 end)
              / nullif(sum(case when lead >= l then rooms else 0 end), 0) + 1.3e-7, 6) + 0.0 as value
        from confirmed cross join (select unnest(generate_series(0, {LEADS - 1})) as l) k group by 1, 2, 3""",
)
def p11(v):
    # a ratio can end exactly on half a unit of the sixth decimal; the small shift takes it off the rounding edge
    curve = pace.adr_pace(confirmed(v), LEADS)
    return slots(curve.withColumn("pace", F.transform("pace", lambda x: x + F.lit(1.3e-7))), "pace")


@check(
    "r05_trim_to_hotel",
    "confirmed hotel_config",
    f"""select HotelID, stay_date, lead_window, cast(l as int) as lead,
          case when l < lead_window then round(sum(case when lead >= l then revenue else 0 end), 6) + 0.0 end as value
        from confirmed join hotel_config using (HotelID)
        cross join (select unnest(generate_series(0, {LEADS - 1})) as l) k group by 1, 2, 3, l""",
)
def r05(v):
    from pacecast.operators.clean import attach_config

    curve = attach_config(pace.pace(confirmed(v), "revenue", LEADS), v.hotel_config, "lead_window")
    trimmed = pace.trim_to_hotel(curve)
    long = trimmed.select(*pace.KEYS, "lead_window", F.posexplode_outer("pace").alias("lead", "value"))
    return long.withColumn("value", r6("value"))


@check(
    "r06_wide_matrix",
    "confirmed",
    "select HotelID, stay_date, "
    + ", ".join(f"round(sum(case when lead >= {i} then rooms else 0 end), 6) + 0.0 as RM{i}" for i in range(LEADS))
    + ", "
    + ", ".join(f"round(sum(case when lead >= {i} then rooms else 0 end), 6) + 0.0 as RM{i}_tgt" for i in range(28))
    + " from confirmed group by 1, 2",
)
def r06(v):
    curve = pace.pace(confirmed(v), "rooms", LEADS).withColumn("target", F.slice("pace", 1, 28))
    wide = pace.widen(curve, "RM", LEADS, 28, keep=pace.KEYS)
    return wide.select(*pace.KEYS, *[r6(c).alias(c) for c in wide.columns if c not in pace.KEYS])
