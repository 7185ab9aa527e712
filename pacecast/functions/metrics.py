"""Error measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sape(actual: Column, forecast: Column) -> Column:
    """2|y - f| / (|y| + |f|); two zeros are a perfect hit."""
    size = F.abs(actual) + F.abs(forecast)
    return F.when(size == 0, F.lit(0.0)).otherwise(F.try_divide(2 * F.abs(actual - forecast), size))


def absolute_error(actual: Column, forecast: Column) -> Column:
    return F.abs(actual - forecast)


def target_column(target_type: str) -> str:
    """Booked amount that a target type sums. ADR is a ratio of two sums: see operators.pace.adr_pace."""
    columns = {"REVENUE": "revenue", "ROOMS": "rooms"}
    if target_type not in columns:
        raise ValueError(f"{target_type} is not a sum of one column")
    return columns[target_type]
