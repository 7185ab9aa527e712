"""Error report over log lines written from the orders table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import views
from checks.registry import check
from pacecast.operators import logs, pace
from pacecast.sources import sinks, tables

views.TEXT["log_lines"] = """
select concat('driver/stderr-', cast(o_custkey % 50 as {S})) as file,
 case when o_orderkey % 13 = 0
      then concat(cast(cast(o_orderdate as date) as {S}), ' 08:15:00,123 - job - ERROR - ',
                  'Error encountered when processing hotel ', cast(o_custkey as {S}), ': no model for ', o_orderpriority)
      else concat(cast(cast(o_orderdate as date) as {S}), ' 08:15:00,123 - job - INFO - Processing Hotel ', cast(o_custkey as {S}))
 end as value
from {orders}"""


@check(
    "n07_f20_error_lines",
    "log_lines",
    """select file, cast(epoch(cast(substring(value, 1, 19) as timestamp)) as bigint) as logged_at,
         regexp_extract(value, 'hotel ([^:]+): (.*)', 1) as HotelID, regexp_extract(value, 'hotel ([^:]+): (.*)', 2) as message
       from log_lines where value like '%Error encountered when processing hotel%'
         and substring(value, 1, 10) >= '1996-01-01'""",
)
def n07(v):
    hits = logs.error_lines(v.log_lines, start=datetime(1996, 1, 1))
    return hits.select("file", F.unix_timestamp("logged_at").alias("logged_at"), "HotelID", "message")


@check(
    "g14_error_counts",
    "log_lines",
    """select file, count(*) as errors from log_lines
       where value like '%Error encountered when processing hotel%' group by 1""",
)
def g14(v):
    return logs.error_counts(logs.error_lines(v.log_lines))


# Each order writes a line; a failing one writes a trace of up to four lines below it, some of them empty.
views.TEXT["traced_lines"] = """
select cast(o_custkey % 5 as {S}) as driver, o_orderkey as id,
 case when o_orderkey % 7 = 0 then cast(o_orderkey % 4 as int) else 0 end as n_trace,
 case when o_orderkey % 7 = 0
      then concat(cast(cast(o_orderdate as date) as {S}), ' 08:15:00,123 - job - ERROR - ',
                  'Error encountered when processing hotel ', cast(o_custkey as {S}), ': no model')
      else concat(cast(cast(o_orderdate as date) as {S}), ' 08:15:00,123 - job - INFO - Processing Hotel ', cast(o_custkey as {S}))
 end as value
from {orders}"""


@check(
    "a09_log_records",
    "traced_lines",
    """select driver, substring(value, 1, 10) as logged_on, regexp_extract(value, 'hotel ([^:]+): (.*)', 1) as HotelID,
         cast(case when n_trace = 3 then 4 else n_trace end as bigint) as n_below,
         case when n_trace > 0 then concat('KeyError: ', cast(id as varchar)) end as last_below, count(*) as n
       from traced_lines where value like '%Error encountered when processing hotel%' group by 1, 2, 3, 4, 5""",
)
def a09(v):
    """Text files of many lines, read in small blocks: traces that cross a block's edge stay with their message.

    A task reads many blocks, so that tasks do not grow in number with the lines."""
    path = v.scratch("logs")
    frames = [F.lit("  File job.py"), F.concat(F.lit("KeyError: "), F.col("id").cast("string"))]
    trace = F.when(F.col("n_trace") == 1, F.concat_ws("\n", "value", frames[1])).when(
        F.col("n_trace") > 1, F.concat_ws("\n", "value", frames[0], frames[1])
    )
    padded = F.when(F.col("n_trace") == 3, F.concat(trace, F.lit("\n \n"))).otherwise(F.coalesce(trace, "value"))
    lines = sinks.rebalance(v.traced_lines.select("driver", padded.alias("value")), "driver")
    lines.write.partitionBy("driver").text(path)
    small = v.spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "16KB")
    small.conf.set("spark.sql.files.maxPartitionNum", str(pace.work_tasks(v.spark)))
    found = logs.log_records(tables.read_log_blocks(small, path))
    day, hotel = F.substring("value", 1, 10).alias("logged_on"), F.regexp_extract("value", logs.ERROR_PATTERN, 1).alias("HotelID")
    driver = F.regexp_extract("file", "driver=([0-9]+)", 1).alias("driver")
    return found.groupBy(driver, day, hotel, "n_below", "last_below").agg(F.count(F.lit(1)).alias("n"))
