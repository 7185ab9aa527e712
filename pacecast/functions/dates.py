"""Calendar expressions. Weeks inside a month or quarter count from its first day; week of year is ISO."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Feature names in the order that model inputs expect.
CALENDAR_FEATURES = (
    "year", "quarter_of_year", "month_of_year", "week_of_year", "day_of_year", "month_of_quarter",
    "week_of_quarter", "day_of_quarter", "week_of_month", "day_of_month", "holiday", "day_of_week_0",
    "day_of_week_1", "day_of_week_2", "day_of_week_3", "day_of_week_4", "day_of_week_5", "day_of_week_6",
)


def calendar_features(day: Column, is_holiday: Column) -> dict[str, Column]:
    """The 18 calendar features of a date; day_of_week_0 is Monday."""
    day_of_quarter = F.datediff(day, F.trunc(day, "quarter")) + 1
    found = {
        "year": F.year(day),
        "quarter_of_year": F.quarter(day),
        "month_of_year": F.month(day),
        "week_of_year": F.weekofyear(day),
        "day_of_year": F.dayofyear(day),
        "month_of_quarter": (F.month(day) - 1) % 3 + 1,
        "week_of_quarter": F.floor((day_of_quarter - 1) / 7).cast("int") + 1,
        "day_of_quarter": day_of_quarter,
        "week_of_month": F.floor((F.dayofmonth(day) - 1) / 7).cast("int") + 1,
        "day_of_month": F.dayofmonth(day),
        "holiday": is_holiday.cast("int"),
    }
    for i in range(7):
        found[f"day_of_week_{i}"] = (F.weekday(day) == i).cast("int")
    return {name: found[name].alias(name) for name in CALENDAR_FEATURES}
