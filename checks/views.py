"""Booking views over the test tables. One SQL text per view serves Spark and DuckDB: {S} is the string type,
{lineitem} etc. stand for the base tables. A view may use the views before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "supplier", "orders", "lineitem")

TEXT = {
    "bookings": """
select l_orderkey as TransactionID, cast(n_regionkey as {S}) as HotelID,
 cast(o_orderdate as date) + cast(l_linenumber as int) as stay_date,
 cast(o_orderdate as date) + cast(l_linenumber as int)
   - cast((l_orderkey*7 + l_partkey*3 + l_linenumber*11) % 120 as int) as confirmation_date,
 case when l_linenumber % 2 = 0 then 'PMS' else 'WEB' end as channel,
 case when o_orderkey % 10 in (1,2) then 'Cancelled'
      when o_orderkey % 10 = 3 then 'No-show' else 'Confirmed' end as status,
 l_extendedprice*(1-l_discount) as revenue, l_quantity as rooms
from {lineitem} join {orders} on l_orderkey=o_orderkey
 join {supplier} on l_suppkey=s_suppkey join {nation} on s_nationkey=n_nationkey""",
    "transactions": """
select o_orderkey as TransactionID,
 case when o_orderkey % 10 in (1,2) and o_orderkey % 50 <> 1
        then cast(o_orderdate as date) - cast(o_orderkey % 30 - 3 as int)
      when o_orderkey % 50 = 4 then cast(o_orderdate as date) end as cancellation_date
from {orders}""",
    "booking_status": """
select * from (values ('confirmed','Confirmed'),('cancelled','Cancelled'),('cancelled','No-show')) t(scenario,status)""",
    "hotel_config": """
select cast(r_regionkey as {S}) as HotelID, concat('Hotel of the region ', r_name) as HotelName,
 case r_regionkey when 0 then 'US' when 1 then 'CA' when 2 then 'GB' when 4 then 'US' end as Country,
 case r_regionkey when 0 then 'NY' when 1 then 'ON' when 2 then 'LDN' when 4 then 'CA' end as State,
 case r_regionkey when 1 then 60 when 3 then 80 else 100 end as lead_window,
 case r_regionkey when 2 then 14 when 4 then 7 else 28 end as inference_length,
 case r_regionkey when 1 then 60 when 2 then 25 when 3 then 80 when 4 then 30 else 40 end as available_rooms,
 'USD' as forecast_currency
from {region}""",
    "exclusions": """
select cast(n_regionkey as {S}) as HotelID,
 case when n_nationkey % 4 = 3 then 'other_pipeline' else 'main_training_pipeline' end as pipeline,
 date '2001-01-01' + cast(n_nationkey % 3 as int) as ts,
 date '1996-01-15' + cast(n_nationkey * 71 as int) as range_start,
 date '1996-01-15' + cast(n_nationkey * 71 + n_nationkey % 20 as int) as range_end
from {nation}""",
    "hotel_stays": "select distinct HotelID, stay_date from bookings",
    "forecasts": """
select HotelID, stay_date, stay_date - 28 as run_date, stay_date - 28 + i as booking_date,
 false as pms_sync_off, i as day_index,
 cast(900 + 37*i + 11*(extract(day from stay_date) % 13) - 50*((i*5) % 7) as double)*150 as y_med,
 cast(1000 + 37*i + 10*(i % 3) as double)*150 as y_upper,
 cast(820 + 36*i - 12*(i % 4) as double)*150 as y_lower
from (select HotelID, stay_date, {path} as i from hotel_stays) p""",
    "room_forecasts": """
select HotelID, stay_date, run_date, booking_date, pms_sync_off, day_index,
 y_med/cast(4500 as double) as y_med, y_upper/cast(4500 as double) as y_upper,
 y_lower/cast(4500 as double) as y_lower from forecasts""",
    "model_versions": """
select concat('m', cast(o_custkey as {S})) as model_name, cast(o_orderkey as int) as version,
 case when o_orderkey % 3 = 0 then 'yes' else 'no' end as stage_dev,
 case when o_orderkey % 7 = 0 then 'yes' else 'no' end as stage_prod
from {orders}""",
    "model_hotels": """
select distinct concat('m', cast(o_custkey as {S})) as model_name, cast(o_custkey % 5 as {S}) as HotelID from {orders}""",
}

NEEDS = {
    "hotel_stays": ("bookings",),
    "forecasts": ("hotel_stays",),
    "room_forecasts": ("forecasts",),
}

DIALECT = {
    "spark": {"S": "string", "path": "explode(sequence(0, 28))"},
    "duckdb": {"S": "varchar", "path": "cast(unnest(generate_series(0, 28)) as int)"},
}


def _closure(names) -> list[str]:
    found: list[str] = []

    def add(name):
        for need in NEEDS.get(name, ()):
            add(need)
        if name not in found:
            found.append(name)

    for name in names:
        add(name)
    return found


def with_clause(names, tables: dict[str, str], engine: str) -> str:
    words = {**DIALECT[engine], **tables}
    parts = [f"{n} as ({TEXT[n].format(**words)}\n)" for n in _closure(names)]
    return "with " + ",\n".join(parts)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the parquet files; no temp view is left in the session."""
    tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in BASE}
    return spark.sql(with_clause([name], tables, "spark") + f" select * from {name}")


def oracle(names, body: str) -> str:
    """DuckDB text: the needed views, then the query. `names` is one string of view names."""
    body = body.strip()
    if not names:
        return body
    head = with_clause(names.split(), {t: t for t in BASE}, "duckdb")
    return head + (",\n" + body[5:] if body[:5].lower() == "with " else "\n" + body)
