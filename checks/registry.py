"""Registry of checked queries: a Spark callable and, where SQL can say it, the DuckDB text beside it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Steps that many oracles start from, in plain SQL.
STEPS = {
    "dated": """
select b.*, case when b.status = 'No-show' and t.cancellation_date is null then b.stay_date
                 else t.cancellation_date end as cancellation_date
from bookings b left join transactions t on b.TransactionID = t.TransactionID
where b.confirmation_date <= b.stay_date""",
    "confirmed": """
select *, stay_date - confirmation_date as lead from dated where cancellation_date is null
 and status in (select status from booking_status where scenario = 'confirmed')""",
    "aware": """
select *, stay_date - confirmation_date as lead, coalesce(stay_date - cancellation_date, -1) as gone from dated
where (cancellation_date is null and status in (select status from booking_status where scenario = 'confirmed'))
   or (cancellation_date <= stay_date and status in (select status from booking_status where scenario = 'cancelled'))""",
}
views.TEXT.update(STEPS)
views.NEEDS.update(
    {
        "dated": ("bookings", "transactions"),
        "confirmed": ("dated", "booking_status"),
        "aware": ("dated", "booking_status"),
    }
)


class Inputs:
    """The booking views of one test folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def scratch(self, name: str) -> str:
        """A new folder below the shared one (a local session without one gets a temporary folder)."""
        root = self.spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not self.spark.conf.get("spark.master", "").startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = "file://" + tempfile.mkdtemp(prefix="checks-")
        return f"{root.rstrip('/')}/checks-{name}-{uuid.uuid4().hex[:12]}"

    def __getattr__(self, name: str) -> DataFrame:
        return views.view(self.spark, self.sf_dir, name)


def check(name: str, uses: str = "", sql: str | None = None):
    """Register `fn(inputs)` under a name, with its oracle text over the views in `uses`."""

    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = views.oracle(uses, sql)
        return fn

    return register


def r6(column: str | Column) -> Column:
    """Six decimals: engines add doubles in different order. The + 0.0 turns -0.0 into 0.0."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, 6) + F.lit(0.0)


def off_edge(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals of means and ratios: these can end on exactly half a unit, so a small shift goes first."""
    return df.withColumns({c: r6(F.col(c) + F.lit(1.3e-7)) for c in columns})


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})
