"""Fits, predictions, repair, backtest, results and model versions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from checks.q_pace import KEPT_SQL, booked_span, holidays, stays_plan
from checks.q_rows import CONFIG, aware, confirmed
from checks.registry import Inputs, check, off_edge, r6, rounded
from pacecast.config import FarFieldConfig, RunConfig
from pacecast.operators import clean, features, monitor, predict, repair, results, versions
from pacecast.plans import backtest, farfield, inference, monitoring, training
from pacecast.sources import sinks, tables

ORIGIN = date(2001, 6, 15)
PUBLISHED = date(2001, 7, 2)  # early enough for bookings after it
FIRST, LAST, STEP = date(2000, 1, 1), date(2000, 12, 1), 14


def quantile_columns():
    return [r6(F.col("offsets")[i]).alias(n) for i, n in enumerate(("q_low", "q_med", "q_high"))]


# Pickup of every hotel, stay, distance and target lead, from the stays that training keeps.
PICKUP_SQL = """
b as (select HotelID, stay_date, d, sum(case when lead >= d and gone < d - 1 then revenue else 0 end) as base
  from aware cross join (select unnest(generate_series(1, 28)) as d) k group by 1, 2, 3),
t as (select HotelID, stay_date, l, sum(case when lead >= l then revenue else 0 end) as target
  from confirmed cross join (select unnest(generate_series(0, 27)) as l) k group by 1, 2, 3),
pickups as (select HotelID, d, l, target - base as pickup
  from kept join b using (HotelID, stay_date) join t using (HotelID, stay_date) where l < d),
params as (select HotelID, d, l, quantile_cont(pickup, 0.1) as lo, quantile_cont(pickup, 0.5) as med,
  quantile_cont(pickup, 0.9) as hi from pickups group by 1, 2, 3)"""


@check(
    "m01_pickup_fit",
    "confirmed aware exclusions",
    "with " + KEPT_SQL.format(cut=f"date '{ORIGIN}'").strip() + "," + PICKUP_SQL + """
       select HotelID, cast(d as int) as day_ahead, cast(l as int) as target_lead,
         round(lo, 6) + 0.0 as q_low, round(med, 6) + 0.0 as q_med, round(hi, 6) + 0.0 as q_high from params""",
)
def m01(v):
    params = training.train(stays_plan(v, ORIGIN, with_features=False), CONFIG)
    return params.select("HotelID", "day_ahead", "target_lead", *quantile_columns())


# Paths to forecast at ORIGIN: booked pace at the origin plus pickup, per point.
PATHS_SQL = """
horizon as (select max(inference_length) as n from hotel_config),
open_stays as (select HotelID, stay_date, cast(stay_date - {o} as int) as d,
    sum(case when stay_date - confirmation_date >= stay_date - {o} then revenue else 0 end) as base
  from confirmed where stay_date > {o} and confirmation_date <= {o}
    and stay_date <= {o} + (select cast(n as int) from horizon) group by 1, 2, 3),
paths as (select HotelID, stay_date, d, l, d - l as day_index, base,
    base + lo as lo, base + med as med, base + hi as hi
  from open_stays join hotel_config using (HotelID) join params using (HotelID, d) where d <= inference_length),
top as (select *, greatest(max(med) over w, med) as top_med, first_value(med) over w as first_med from paths
  window w as (partition by HotelID, stay_date order by day_index rows unbounded preceding))"""



def forecast_sql(origin: date) -> str:
    cut = f"date '{origin}'"
    return "with " + KEPT_SQL.format(cut=cut).strip() + "," + PICKUP_SQL + "," + PATHS_SQL.format(o=cut)


FORECAST_SQL = forecast_sql(ORIGIN)


def params_at_origin(v, origin=ORIGIN):
    return training.train(stays_plan(v, origin, with_features=False), CONFIG)


def matrix_at_origin(v, origin=ORIGIN):
    return inference.inference_matrix(confirmed(v), CONFIG, v.hotel_config, origin, with_features=False)


@check(
    "m03_r04_pickup_predict",
    "confirmed aware exclusions hotel_config",
    FORECAST_SQL + """
       select HotelID, stay_date, d as day_ahead, cast(day_index - 1 as int) as booking_index, cast(l as int) as target_lead,
         round(lo, 6) + 0.0 as y_lower_raw, round(med, 6) + 0.0 as y_med_raw, round(hi, 6) + 0.0 as y_upper_raw
       from paths""",
)
def m03(v):
    rows = features.inference_rows(matrix_at_origin(v))
    long = results.explode_path(predict.pickup_predict(rows, params_at_origin(v)), *predict.RAW)
    return rounded(long, *predict.RAW)


@check(
    "m07_f04_forecast_table",
    "confirmed aware exclusions hotel_config",
    FORECAST_SQL + """,
       fixed as (select HotelID, stay_date, day_index, l, top_med as y_med,
           greatest(hi + greatest(med, first_med) - abs(med), top_med) as y_upper, least(lo, top_med) as y_lower,
           med as y_med_raw, hi as y_upper_raw, lo as y_lower_raw from top
         union all
         select distinct HotelID, stay_date, 0, d, base, base, base, base, base, base from paths)
       select HotelID, 'run1' as run_id, stay_date, cast(stay_date - cast(l as int) as date) as booking_date, 1 as model_version,
         false as pms_sync_off, 'USD' as forecast_currency, cast(day_index as int) as day_index,
         round(y_med, 6) + 0.0 as y_med, concat(HotelID, '_REVENUE_PMS_PICKUP_model') as model_name,
         round(y_upper, 6) + 0.0 as y_upper, round(y_lower, 6) + 0.0 as y_lower,
         round(y_med_raw, 6) + 0.0 as y_med_raw, round(y_upper_raw, 6) + 0.0 as y_upper_raw,
         round(y_lower_raw, 6) + 0.0 as y_lower_raw from fixed""",
)
def m07_table(v):
    table = inference.forecast(
        matrix_at_origin(v), params_at_origin(v), CONFIG, "run1", datetime(2001, 6, 15)
    )
    return rounded(results.completed(table, "REVENUE").drop("timestamp"), *results.PATHS)


REPAIR_SQL = """
t as (select *, max(y_med) over w as top, first_value(y_med) over w as first_med from {forecasts}
  window w as (partition by HotelID, stay_date, run_date order by day_index rows unbounded preceding)),
r as (select HotelID, stay_date, run_date, day_index, y_med as y_med_raw, top as y_med,
  greatest(y_upper + greatest(y_med, first_med) - abs(y_med), top) as y_upper, least(y_lower, top) as y_lower from t)"""
PATH = ("HotelID", "stay_date", "run_date")


@check(
    "m07_w04_dip_repair",
    "forecasts",
    "with " + REPAIR_SQL.format(forecasts="forecasts").strip() + """
       select HotelID, stay_date, run_date, day_index, y_med_raw, round(y_med, 6) + 0.0 as y_med,
         round(y_upper, 6) + 0.0 as y_upper, round(y_lower, 6) + 0.0 as y_lower from r""",
)
def m07(v):
    fixed = repair.repair_rows(v.forecasts, PATH)
    return rounded(
        fixed.select(*PATH, "day_index", "y_med_raw", "y_med", "y_upper", "y_lower"), "y_med", "y_upper", "y_lower"
    )


@check(
    "m08_capacity_cap",
    "room_forecasts hotel_config",
    "with " + REPAIR_SQL.format(forecasts="room_forecasts").strip() + """
       select HotelID, stay_date, run_date, day_index, round(least(y_med, available_rooms), 6) + 0.0 as y_med,
         round(least(y_upper, available_rooms), 6) + 0.0 as y_upper,
         round(least(y_lower, available_rooms), 6) + 0.0 as y_lower from r join hotel_config using (HotelID)""",
)
def m08(v):
    fixed = clean.attach_config(repair.repair_rows(v.room_forecasts, PATH), v.hotel_config, "available_rooms")
    kept = repair.cap_rows(fixed).select(*PATH, "day_index", "y_med", "y_upper", "y_lower")
    return rounded(kept, "y_med", "y_upper", "y_lower")


@check(
    "w07_linear_fill",
    "forecasts",
    """with g as (select HotelID, stay_date, run_date, day_index,
           case when (day_index * 7 + day(stay_date)) % 5 in (1, 2) then null else y_med end as y from forecasts),
       m as (select *,
           last_value(case when y is not null then day_index end ignore nulls) over b as i0, last_value(y ignore nulls) over b as y0,
           first_value(case when y is not null then day_index end ignore nulls) over a as i1, first_value(y ignore nulls) over a as y1
         from g window b as (partition by HotelID, stay_date, run_date order by day_index rows between unbounded preceding and current row),
           a as (partition by HotelID, stay_date, run_date order by day_index rows between current row and unbounded following))
       select HotelID, stay_date, run_date, day_index, y is null as was_missing,
         round(coalesce(y, y0 + (y1 - y0) * (day_index - i0) / nullif(i1 - i0, 0), y0, y1), 6) + 0.0 as y_med from m""",
)
def w07(v):
    hole = (F.col("day_index") * 7 + F.dayofmonth("stay_date")) % 5
    gaps = v.forecasts.select(
        *PATH, "day_index", hole.isin(1, 2).alias("was_missing"), F.when(~hole.isin(1, 2), F.col("y_med")).alias("y_med")
    )
    return rounded(repair.fill_rows(gaps, PATH, "day_index", "y_med"), "y_med")


@check(
    "m09_failure_reasons",
    "confirmed hotel_config exclusions aware",
    FORECAST_SQL + """
       select HotelID, case HotelID when '1' then 'incomplete' else 'complete' end as status,
         case HotelID when '1' then 'forecast currency is missing for a revenue forecast'
           else concat('Successfully processed ', HotelID) end as message,
         case HotelID when '1' then 1 else count(*) + count(distinct stay_date) end as n
       from paths group by 1""",
)
def m09_reasons(v):
    """A hotel without a currency fails alone, with its reason; the others complete."""
    no_currency = F.when(F.col("HotelID") != "1", F.col("forecast_currency"))
    hotels = v.hotel_config.withColumn("forecast_currency", no_currency)
    matrix = inference.inference_matrix(confirmed(v), CONFIG, hotels, ORIGIN, with_features=False)
    table = results.one_failure_each(inference.forecast(matrix, params_at_origin(v), CONFIG, "run1", datetime(2001, 6, 15)))
    return table.groupBy("HotelID", "status", "message").agg(F.count("*").alias("n"))


@check(
    "n04_from_published",
    "confirmed hotel_config exclusions aware",
    forecast_sql(PUBLISHED) + """,
       seen as (select HotelID, stay_date, stay_date - confirmation_date as l, sum(revenue) as revenue
         from confirmed group by 1, 2, 3),
       booked as (select *, sum(revenue) over (partition by HotelID, stay_date order by l desc) as y_true from seen)
       select t.HotelID, t.stay_date, cast(t.stay_date - cast(t.l as int) as date) as confirmation_date, t.d as day_ahead_index,
         cast(day_index as int) as booking_index, round(top_med, 6) + 0.0 as y_pred, round(y_true, 6) + 0.0 as y_true,
         false as pms_sync_off, 'REVENUE' as target_type
       from top t join booked b on b.HotelID = t.HotelID and b.stay_date = t.stay_date and b.l = t.l where y_true <> 0""",
)
def n04_published(v):
    """Monitoring takes the rows that forecasting publishes."""
    table = inference.forecast(matrix_at_origin(v, PUBLISHED), params_at_origin(v, PUBLISHED), CONFIG, "run1", datetime(2001, 6, 15))
    rows = monitoring.summary({"REVENUE": results.completed(table, "REVENUE")}, confirmed(v), PUBLISHED, PUBLISHED)
    kept = rows.drop("timestamp", "SAPE", "eval_start_date", "eval_end_date", "scored_at")
    return rounded(kept, "y_pred", "y_true")


def results_at_origin(v):
    """Forecasts with failure rows. Hotels are done when they have paths, which is known before these are exploded."""
    matrix, params = matrix_at_origin(v), params_at_origin(v)
    table = inference.forecast(matrix, params, CONFIG, "run1", datetime(2001, 6, 15))
    done = inference.repaired_paths(matrix, params, CONFIG)
    lost = results.failure_rows(v.hotel_config.select("HotelID"), done, "run1", inference.NO_DATA)
    return table.unionByName(lost)


@check(
    "m09_f23_failure_rows",
    "confirmed hotel_config exclusions aware",
    FORECAST_SQL + """,
       done as (select HotelID, count(*) + count(distinct stay_date) as n from paths group by 1)
       select HotelID, case when n is null then 'incomplete' else 'complete' end as status, coalesce(n, 1) as n,
         case when n is null then date '1900-01-01' end as sentinel from hotel_config left join done using (HotelID)""",
)
def m09(v):
    return results_at_origin(v).groupBy("HotelID", "status").agg(
        F.count("*").alias("n"), F.min(F.when(F.col("status") != "complete", F.col("stay_date"))).alias("sentinel")
    )


@check(
    "g11_run_summary",
    "confirmed hotel_config exclusions aware",
    FORECAST_SQL + """
       select (select count(distinct HotelID) from paths) as hotels_completed, count(*) as hotels_total from hotel_config""",
)
def g11(v):
    return results.run_summary(results_at_origin(v))


@check(
    "m09_training_run",
    "confirmed hotel_config exclusions",
    "with " + KEPT_SQL.format(cut="date '1995-01-06'").strip() + """,
       asked as (select HotelID from hotel_config union all select distinct concat('x', HotelID) from bookings)
       select HotelID, 'run1' as run_id, 1 as model_version, false as pms_sync_off,
         concat(HotelID, '_REVENUE_PMS_PICKUP_model') as model_name,
         case when HotelID in (select HotelID from kept) then 'complete' else 'incomplete' end as status,
         case when HotelID in (select HotelID from kept) then concat('Successfully trained ', HotelID)
              else 'No training rows' end as message from asked""",
)
def m09_training(v):
    params = training.train(stays_plan(v, date(1995, 1, 6), with_features=False), CONFIG)
    more = v.bookings.select(F.concat(F.lit("x"), F.col("HotelID")).alias("HotelID")).distinct()
    asked = v.hotel_config.select("HotelID").unionByName(more)
    return results.training_run(asked, params, "REVENUE", "run1", datetime(2001, 6, 15)).drop("timestamp")


BACKTEST_SQL = f"""
origins as (select date '{FIRST}' + cast(i as int) as o
  from (select unnest(generate_series(0, date '{LAST}' - date '{FIRST}', {STEP})) as i) g),
fb as (select HotelID, stay_date, d, sum(case when lead >= d then revenue else 0 end) as base
  from confirmed cross join (select unnest(generate_series(1, 28)) as d) k where stay_date <= date '{FIRST}' group by 1, 2, 3),
ft as (select HotelID, stay_date, l, sum(case when lead >= l then revenue else 0 end) as target
  from confirmed cross join (select unnest(generate_series(0, 27)) as l) k where stay_date <= date '{FIRST}' group by 1, 2, 3),
fp as (select HotelID, d, l, quantile_cont(target - base, 0.5) as med from fb join ft using (HotelID, stay_date)
  where l < d group by 1, 2, 3),
seen as (select HotelID, stay_date, o, cast(stay_date - o as int) as d,
    sum(case when confirmation_date <= o then revenue else 0 end) as base,
    count(case when confirmation_date <= o then 1 end) as n
  from confirmed join origins on stay_date > o and stay_date <= o + 28 group by 1, 2, 3, 4),
bt as (select s.HotelID, s.stay_date, s.o as eval_start, cast(s.o + 28 as date) as eval_end, cast(s.d - l - 1 as int) as booking_index,
    s.base + med as y_pred,
    (select sum(case when c.lead >= l then revenue else 0 end) from confirmed c
      where c.HotelID = s.HotelID and c.stay_date = s.stay_date) as y_true
  from seen s join fp on fp.HotelID = s.HotelID and fp.d = s.d where s.n > 0)"""


def backtest_rows(v):
    return backtest.backtest(confirmed(v), CONFIG, FIRST, LAST, STEP)


@check(
    "m10_sliding_backtest",
    "confirmed",
    "with " + BACKTEST_SQL.strip() + """
       select HotelID, stay_date, eval_start, eval_end, booking_index, round(y_pred, 6) + 0.0 as y_pred,
         round(y_true, 6) + 0.0 as y_true from bt""",
)
def m10(v):
    return rounded(backtest_rows(v), "y_pred", "y_true").drop("pms_sync_off", "status")


@check(
    "m10_linear_backtest",
    "confirmed",
    "with " + BACKTEST_SQL.strip() + """
       select HotelID, stay_date, eval_start, eval_end, booking_index, true as predicted,
         round(y_true, 6) + 0.0 as y_true from bt""",
)
def m10_linear(v):
    """The linear model over the same origins, paths and truths; every point gets a finite prediction."""
    config = RunConfig(lags=(), pace_features=7)
    rows = backtest.backtest(confirmed(v), config, FIRST, LAST, STEP, "linear")
    finite = F.col("y_pred").isNotNull() & ~F.isnan("y_pred") & (F.abs("y_pred") < 1e12)
    return rounded(
        rows.select("HotelID", "stay_date", "eval_start", "eval_end", "booking_index", finite.alias("predicted"), "y_true"), "y_true"
    )


SAPE_SQL = "case when abs(y_true) + abs(y_pred) = 0 then 0 else 2 * abs(y_true - y_pred) / (abs(y_true) + abs(y_pred)) end"
PATH_METRICS_SQL = """
pm as (select HotelID, stay_date, eval_start, eval_end,
""" + ",\n".join(
    f"  avg(case when booking_index < {n} then {SAPE_SQL} end) as SMAPE{n}, "
    f"avg(case when booking_index < {n} then abs(y_true - y_pred) end) as MAE{n}"
    for n in (7, 14, 28)
) + "\n from bt group by 1, 2, 3, 4)"
METRICS = [f"{m}{n}" for n in (7, 14, 28) for m in ("SMAPE", "MAE")]
ROUNDED_METRICS = ", ".join(f"round({m} + 1.3e-7, 6) + 0.0 as {m}" for m in METRICS)


@check(
    "g08_g09_s02_path_metrics",
    "confirmed",
    "with " + BACKTEST_SQL.strip() + "," + PATH_METRICS_SQL
    + f" select HotelID, stay_date, eval_start, eval_end, {ROUNDED_METRICS} from pm",
)
def g08(v):
    return off_edge(monitor.path_metrics(backtest_rows(v)), *METRICS)


@check(
    "g10_j09_u02_metric_summary",
    "confirmed hotel_config",
    "with " + BACKTEST_SQL.strip() + "," + PATH_METRICS_SQL + """
       select eval_start, eval_end, HotelID, HotelName, """
    + ", ".join(f"round(avg({m}) + 1.3e-7, 6) + 0.0 as {m}" for m in METRICS)
    + """ from pm join hotel_config using (HotelID)
       group by grouping sets ((HotelID, HotelName), (eval_start, eval_end, HotelID, HotelName), (eval_start, eval_end))""",
)
def g10(v):
    named = monitor.name_metrics(monitor.path_metrics(backtest_rows(v)), v.hotel_config)
    return off_edge(monitor.metric_summary(named, METRICS), *METRICS)


# Hold-out: fit on stays before each hotel's last 28 days, predict those days at their own distance.
HOLDOUT_SQL = """
ends as materialized (select HotelID, max(stay_date) as last from confirmed group by 1),
cells as materialized (select HotelID, stay_date, lead, gone, sum(revenue) as revenue from aware group by 1, 2, 3, 4),
b as materialized (select HotelID, stay_date, d, sum(case when lead >= d and gone < d - 1 then revenue else 0 end) as base
  from cells cross join (select unnest(generate_series(1, 28)) as d) k group by 1, 2, 3),
t as materialized (select HotelID, stay_date, l, sum(case when lead >= l then revenue else 0 end) as target
  from cells cross join (select unnest(generate_series(0, 27)) as l) k where gone = -1 group by 1, 2, 3),
marked as materialized (select b.*, stay_date < last - 28 as early, cast(stay_date - (last - 28) as int) = d as asked
  from b join ends using (HotelID)),
params as materialized (select HotelID, d, l, quantile_cont(target - base, 0.5) as med
  from (select * from marked where early) join t using (HotelID, stay_date) where l < d group by 1, 2, 3),
points as materialized (select HotelID, stay_date, d, l, base + med as y_pred
  from (select * from marked where asked) join params using (HotelID, d)),
ho as (select HotelID, stay_date, d, l, y_pred, target as y_true from points join t using (HotelID, stay_date, l))"""


def holdout_table(v):
    train, test = training.holdout(training.stays_from(aware(v), CONFIG), CONFIG)
    no_lags = RunConfig(lags=())
    params = training.train(train, no_lags)
    rows = training.holdout_model_rows(test, no_lags)
    return results.holdout_rows(predict.pickup_predict(rows, params))


@check(
    "m11_holdout_rows",
    "confirmed aware",
    "with " + HOLDOUT_SQL.strip() + """
       select HotelID, false as pms_sync_off, 'complete' as status, concat('Successfully trained ', HotelID) as message,
         stay_date, cast(d - l - 1 as int) as booking_index, round(y_pred, 6) + 0.0 as y_pred, round(y_true, 6) + 0.0 as y_true from ho""",
)
def m11(v):
    return rounded(holdout_table(v), "y_pred", "y_true")


@check(
    "g13_holdout_metrics",
    "confirmed aware",
    "with " + HOLDOUT_SQL.strip()
    + f" select HotelID, round(avg({SAPE_SQL}) + 1.3e-7, 6) + 0.0 as SMAPE, round(avg(abs(y_true - y_pred)) + 1.3e-7, 6) + 0.0 as MAE from ho group by 1",
)
def g13(v):
    return off_edge(monitor.holdout_metrics(holdout_table(v)), "SMAPE", "MAE")


FAR = FarFieldConfig(lags=())
WIDE = FarFieldConfig(points=(119, 35), lags=())


def far_sql(points) -> str:
    """Cells are summed once; quantiles of a point come from one pass."""
    return f"""
ends as (select HotelID, max(stay_date) as last from confirmed group by 1),
points as (select unnest([{", ".join(map(str, points))}]) as p),
keys as (select distinct HotelID, stay_date from confirmed),
cells as materialized (select HotelID, stay_date, lead, gone, sum(revenue) as revenue
  from aware semi join keys using (HotelID, stay_date) group by 1, 2, 3, 4),
fb as materialized (select HotelID, stay_date, p, sum(case when lead >= p and gone < p then revenue else 0 end) as base,
    sum(case when gone = -1 and lead >= p - 7 then revenue else 0 end) as target
  from cells cross join points group by 1, 2, 3),
far as (select fb.HotelID, p, quantile_cont(target - base, [0.1, 0.5, 0.9]) as q
  from fb join ends using (HotelID) where stay_date < last - {max(points)} group by 1, 2)"""


FAR_SQL = far_sql(FAR.points)
FIT_ROWS = """
       select HotelID, cast(p as int) as day_ahead, cast(p - 7 as int) as target_lead, round(q[1], 6) + 0.0 as q_low,
         round(q[2], 6) + 0.0 as q_med, round(q[3], 6) + 0.0 as q_high from far"""


def far_fit(v, config):
    split = features.horizon_split(training.stays_from(aware(v), config), max(config.points))
    params = training.train(split.where(~F.col("is_test")), config)
    return params.select("HotelID", "day_ahead", "target_lead", *quantile_columns())


@check("m05_far_field_fit", "confirmed aware", "with " + FAR_SQL.strip() + FIT_ROWS)
def m05(v):
    return far_fit(v, FAR)


@check("m05_wide_points", "confirmed aware", "with " + far_sql(WIDE.points).strip() + FIT_ROWS)
def m05_wide(v):
    return far_fit(v, WIDE)


FAR_ENDS_SQL = """,
       asked as materialized (select HotelID, p, cast(last - 91 + cast(p as int) as date) as stay_date from ends cross join points),
       found as materialized (select a.HotelID, a.p, a.stay_date, base, target
         from asked a left join fb on fb.HotelID = a.HotelID and fb.stay_date = a.stay_date and fb.p = a.p)"""


@check(
    "m12_far_field_results",
    "confirmed aware",
    "with " + FAR_SQL.strip() + FAR_ENDS_SQL + """
       select HotelID, stay_date, cast(p as int) as prediction_point, round(coalesce(target, 0), 6) + 0.0 as y_true,
         round(coalesce(base + q[2], 0), 6) + 0.0 as y_pred, round(coalesce(base + q[1], 0), 6) + 0.0 as y_lower,
         round(coalesce(base + q[3], 0), 6) + 0.0 as y_upper
       from found left join far using (HotelID, p)""",
)
def m12(v):
    found = farfield.evaluate(training.stays_from(aware(v), FAR), FAR)
    return rounded(found, "y_true", "y_pred", "y_lower", "y_upper")


@check(
    "m12_linear_results",
    "confirmed aware",
    "with " + FAR_SQL.strip() + FAR_ENDS_SQL + """
       select HotelID, stay_date, cast(p as int) as prediction_point, round(coalesce(target, 0), 6) + 0.0 as y_true,
         true as predicted from found""",
)
def m12_linear(v):
    """Far-field regression lines over the last stays: every point gets finite bounds."""
    found = farfield.evaluate(training.stays_from(aware(v), FAR), FAR, "linear")
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e12) for c in ("y_pred", "y_lower", "y_upper")]
    return rounded(
        found.select("HotelID", "stay_date", "prediction_point", "y_true", (finite[0] & finite[1] & finite[2]).alias("predicted")),
        "y_true",
    )


FULL, FULL_PATH = RunConfig(), RunConfig(recursive=True)


@check("m02_linear_quantile_fit")
def m02(v):
    return training.train(stays_plan(v, ORIGIN, FULL, calendar_features=True), FULL, "linear")


FITTED_SQL = """
       select HotelID, cast(d as int) as day_ahead, cast(l as int) as target_lead, count(*) as n_rows, {marks}
       from kept cross join (select unnest(generate_series(1, 28)) as d) a cross join (select unnest(generate_series(0, 27)) as l) b
       where l < d group by 1, 2, 3"""


def fitted_paths(v):
    """In-sample predictions of the full linear models, a row a path point."""
    stays = stays_plan(v, ORIGIN, FULL, calendar_features=True)
    params = sinks.stage(training.train(stays, FULL, "linear"), v.scratch("linear-params"))
    predicted = predict.linear_predict(training.model_rows(stays, FULL), params)
    return results.explode_path(predicted, "y", *predict.RAW)


POINT = ("HotelID", "day_ahead", "target_lead")


@check(
    "m02_linear_fit_beats_constant",
    "confirmed exclusions",
    "with " + KEPT_SQL.format(cut=f"date '{ORIGIN}'").strip()
    + FITTED_SQL.format(marks="true as low_fits, true as med_fits, true as high_fits"),
)
def m02_quality(v):
    """In-sample pinball loss of every fitted line against the plain quantile of its targets."""
    long = fitted_paths(v)
    constant = long.groupBy(*POINT).agg(F.percentile("y", F.array(*map(F.lit, FULL.quantiles))).alias("q"))

    def loss(forecast, q):
        rest = F.col("y") - forecast
        return F.avg(F.greatest(rest * q, rest * (q - 1)))

    named = zip(("low_fits", "med_fits", "high_fits"), predict.RAW, FULL.quantiles)
    fits = [
        (loss(F.col(raw), q) <= loss(F.col("q")[i], q) * 1.01 + 1e-6).alias(name) for i, (name, raw, q) in enumerate(named)
    ]
    return long.join(constant, list(POINT)).groupBy(*POINT).agg(F.count("*").alias("n_rows"), *fits)


@check(
    "m02_linear_optimality",
    "confirmed exclusions",
    "with " + KEPT_SQL.format(cut=f"date '{ORIGIN}'").strip()
    + FITTED_SQL.format(marks="true as low_optimal, true as med_optimal, true as high_optimal"),
)
def m02_optimality(v):
    """A quantile line leaves its share of the rows below it: no more strictly below, no fewer at or below, give or take
    two rows (the line passes through one, and two engines add its products in different order)."""
    named = zip(("low_optimal", "med_optimal", "high_optimal"), predict.RAW, FULL.quantiles)

    def optimal(raw, q):
        near = 1e-6 * (1 + F.abs("y"))
        below = F.count_if(F.col("y") < F.col(raw) - near)
        not_above = F.count_if(F.col("y") <= F.col(raw) + near)
        return (below <= q * F.count("*") + 2) & (not_above >= q * F.count("*") - 2)

    marks = [optimal(raw, q).alias(name) for name, raw, q in named]
    return fitted_paths(v).groupBy(*POINT).agg(F.count("*").alias("n_rows"), *marks)


@check(
    "m02_constant_is_quantile",
    "confirmed exclusions",
    "with " + KEPT_SQL.format(cut=f"date '{ORIGIN}'").strip() + """,
       t as (select HotelID, stay_date, l, sum(case when lead >= l then revenue else 0 end) as target
         from confirmed cross join (select unnest(generate_series(0, 27)) as l) k group by 1, 2, 3)
       select HotelID, cast(d as int) as day_ahead, cast(l as int) as target_lead,
         round(quantile_cont(target, 0.1) + 1.3e-4, 2) + 0.0 as q_low, round(quantile_cont(target, 0.5) + 1.3e-4, 2) + 0.0 as q_med,
         round(quantile_cont(target, 0.9) + 1.3e-4, 2) + 0.0 as q_high
       from kept join t using (HotelID, stay_date) cross join (select unnest(generate_series(1, 28)) as d) k
       where l < d group by 1, 2, 3""",
)
def m02_constant(v):
    """Without features the line is a constant, and the best constant is the plain quantile."""
    config = RunConfig(lags=(), pace_features=0)
    params = training.train(stays_plan(v, ORIGIN, config, with_features=False), config, "linear")
    values = [
        (F.round(F.col("intercepts")[i] + 1.3e-4, 2) + F.lit(0.0)).alias(n) for i, n in enumerate(("q_low", "q_med", "q_high"))
    ]
    return params.select(*POINT, *values)


def attached(v):
    """v with its bookings and their cancellation dates staged: what reads them several times meets orders and cancellations
    once."""
    out = Inputs(v.spark, v.sf_dir)
    dated = clean.attach_cancellations(v.bookings, v.transactions).drop("TransactionID")
    out.bookings, out.transactions = sinks.stage(dated, v.scratch("attached")), None
    return out


def recursive_forecast(v):
    v = attached(v)
    params = training.train(stays_plan(v, ORIGIN, FULL_PATH, calendar_features=True), FULL_PATH, "linear")
    params = sinks.stage(params, v.scratch("path-params"))
    days_off = holidays(v, *booked_span(v))
    matrix = inference.inference_matrix(confirmed(v), FULL_PATH, tables.clean_hotels(v.hotel_config), ORIGIN, days_off)
    return inference.forecast(matrix, params, FULL_PATH, "run1", datetime(2001, 6, 15), "linear")


@check("m04_recursive_path")
def m04(v):
    return recursive_forecast(v)


@check(
    "m04_path_properties",
    "confirmed hotel_config",
    f"""select HotelID, stay_date, cast(stay_date - date '{ORIGIN}' + 1 as bigint) as points,
          round(sum(revenue), 6) + 0.0 as known_pace, true as never_falls, true as bands_ordered
        from confirmed join hotel_config using (HotelID)
        where stay_date > date '{ORIGIN}' and stay_date <= date '{ORIGIN}' + 28 and stay_date - date '{ORIGIN}' <= inference_length
          and confirmation_date <= date '{ORIGIN}' group by 1, 2""",
)
def m04_properties(v):
    path = F.array_sort(F.collect_list(F.struct("day_index", "y_med")))
    ordered = (F.col("y_lower") <= F.col("y_med")) & (F.col("y_med") <= F.col("y_upper"))
    predicted = F.col("day_index") > 0
    per_stay = recursive_forecast(v).groupBy("HotelID", "stay_date").agg(
        F.count("*").alias("points"),
        r6(F.max(F.when(~predicted, F.col("y_med")))).alias("known_pace"),
        F.filter(path, lambda p: p["day_index"] > 0).alias("path"),
        F.bool_and(ordered).alias("bands_ordered"),
    )
    medians = F.transform("path", lambda p: p["y_med"])
    return per_stay.select(
        "HotelID", "stay_date", "points", "known_pace", (medians == F.array_sort(medians)).alias("never_falls"), "bands_ordered"
    )


@check(
    "m06_missing_distances",
    "confirmed hotel_config",
    f"""with s as (select distinct HotelID, cast(stay_date - date '{ORIGIN}' as int) as day_ahead from confirmed
          join hotel_config using (HotelID)
          where stay_date > date '{ORIGIN}' and confirmation_date <= date '{ORIGIN}' and stay_date <= date '{ORIGIN}' + 28
            and stay_date - date '{ORIGIN}' <= inference_length)
       select HotelID, day_ahead from s where day_ahead > 14""",
)
def m06(v):
    config = RunConfig(horizon=14, lags=())
    params = training.train(stays_plan(v, ORIGIN, config), config)
    rows = features.inference_rows(inference.inference_matrix(confirmed(v), config, v.hotel_config, ORIGIN))
    return predict.missing_distances(rows, params)


@check(
    "v01_w06_latest_version",
    "model_versions",
    """select model_name, max(version) as newest, max(case when stage_prod = 'yes' then version end) as newest_prod
       from model_versions group by 1""",
)
def v01(v):
    newest = versions.latest_version(v.model_versions).withColumnRenamed("version", "newest")
    tagged = versions.latest_version(v.model_versions, "prod").withColumnRenamed("version", "newest_prod")
    return newest.join(tagged, "model_name", "left")


@check(
    "v01_versioned_forecast",
    "confirmed hotel_config exclusions aware",
    FORECAST_SQL + """,
       used as (select HotelID, case HotelID when '3' then 1 else 2 end as version from hotel_config where HotelID <> '4')
       select HotelID, stay_date, cast(day_index as int) as day_index, version as model_version, 'complete' as status,
         'Successfully processed ' || HotelID as message, round(base + (med - base) + 100 * (version - 1), 6) + 0.0 as y_med_raw
       from paths join used using (HotelID)
       union all select distinct HotelID, stay_date, 0, version, 'complete', 'Successfully processed ' || HotelID,
         round(base, 6) + 0.0 from paths join used using (HotelID)
       union all select '4', date '1900-01-01', 0, 0, 'incomplete', 'no model version for the stage', 0.0""",
)
def v01_forecast(v):
    """Two versions of every hotel's model; a tag picks each hotel's, and a hotel without one fails alone."""
    first = params_at_origin(v)
    second = first.withColumn("offsets", F.transform("offsets", lambda x: x + 100))
    both = versions.named(first, 1, "REVENUE", "pickup").unionByName(versions.named(second, 2, "REVENUE", "pickup"))
    newest = F.when(F.col("HotelID") == "3", 1).when(F.col("HotelID") != "4", 2)
    listed = v.hotel_config.select(
        versions.model_name("REVENUE", "pickup").alias("model_name"), F.explode(F.array(F.lit(1), F.lit(2))).alias("version"),
        newest.alias("_newest"),
    ).withColumn("stage_prod", F.when(F.col("version") <= F.col("_newest"), "yes").otherwise("no"))
    picked = versions.pick(both, listed, "prod")
    table = inference.forecast(matrix_at_origin(v), picked, CONFIG, "run1", datetime(2001, 6, 15))
    hotels = v.hotel_config.select("HotelID", "forecast_currency").join(params_at_origin(v), "HotelID", "left_semi")
    lost = results.failure_rows(versions.unpicked(hotels, picked), picked, "run1", inference.NO_VERSION)
    rows = table.unionByName(lost)
    return rounded(
        rows.select("HotelID", "stay_date", "day_index", "model_version", "status", "message", "y_med_raw"), "y_med_raw"
    )


@check(
    "v02_promote_stage",
    "model_versions",
    """select model_name, version, stage_prod, case when stage_dev = 'yes' and version < max(case when stage_dev = 'yes'
         then version end) over (partition by model_name) then 'no' else stage_dev end as stage_dev from model_versions""",
)
def v02(v):
    return versions.promote(v.model_versions, "dev").select("model_name", "version", "stage_dev", "stage_prod")


@check(
    "v03_version_inventory",
    "model_versions model_hotels hotel_config",
    """select HotelID, model_name, max(version) as version, inference_length, lead_window
       from model_versions join model_hotels using (model_name) join hotel_config using (HotelID) group by 1, 2, 4, 5""",
)
def v03(v):
    listed = versions.inventory(versions.latest_version(v.model_versions), v.model_hotels, v.hotel_config)
    return listed.select("HotelID", "model_name", "version", "inference_length", "lead_window")
