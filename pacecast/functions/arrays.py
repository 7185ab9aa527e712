"""Column expressions over short arrays: pace slots, gap filling, dot products, quantiles.

A "cell" is struct(lead, gone, amount): money or rooms booked `lead` days before the stay and cancelled
`gone` days before it (-1 = never, -2 = for targets alone). Cells come sorted by lead, highest first, at most
lead_window x (snapshots + 1) of them per stay, so the folds below run over bounded arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def confirmed_cells(cells: Column) -> Column:
    return F.filter(cells, lambda c: c["gone"] < F.lit(0))


def pace_between(cells: Column, lo: Column | int, hi: Column | int) -> Column:
    """Totals on the books at leads lo..hi-1, slot 0 = lead lo. One walk over the cells.

    Between two booked leads the total stands still, so each cell closes a run of equal slots.
    """
    lo, hi = _col(lo), _col(hi)
    start = F.struct(
        F.lit(0.0).alias("total"),
        (hi - 1).cast("int").alias("top"),
        F.array().cast("array<double>").alias("slots"),
    )

    def step(acc, cell):
        at = F.least(cell["lead"], (hi - 1).cast("int"))
        return F.struct(
            (acc["total"] + cell["amount"]).alias("total"),
            at.alias("top"),
            F.concat(acc["slots"], F.array_repeat(acc["total"], acc["top"] - at)).alias("slots"),
        )

    def finish(acc):
        rest = F.array_repeat(acc["total"], (acc["top"] - lo + 1).cast("int"))
        return F.reverse(F.concat(acc["slots"], rest))

    return F.aggregate(F.filter(cells, lambda c: c["lead"] >= lo), start, step, finish)


def gone_cells(cells: Column) -> Column:
    return F.filter(cells, lambda c: c["gone"] >= F.lit(0))


def seen_cells(cells: Column) -> Column:
    """Without the cells that are for targets alone."""
    return F.filter(cells, lambda c: c["gone"] > F.lit(-2))


def snapshots_between(lasting: Column, gone: Column, first: Column | int, last: Column | int) -> Column:
    """The pace of every snapshot first..last over all slots of `lasting`, as one array of arrays, in one fold.

    Snapshot k differs from k - 1 by the cells that were cancelled k - 1 days before the stay; only these are walked, and a
    snapshot without any is its predecessor. So a cancelled cell is walked once, not once for each later snapshot.
    """
    first, last, width = _col(first).cast("int"), _col(last).cast("int"), F.size(lasting)

    def more(done, cells):
        return F.when(F.size(cells) == 0, done).otherwise(
            F.zip_with(done, pace_between(cells, 0, width), lambda a, b: a + b)
        )

    before = more(lasting, F.filter(gone, lambda c: c["gone"] < first))
    start = F.struct(before.alias("now"), F.array(before).alias("all"))

    def step(acc, k):
        now = more(acc["now"], F.filter(gone, lambda c: c["gone"] == k - 1))
        return F.struct(now.alias("now"), F.concat(acc["all"], F.array(now)).alias("all"))

    later = F.when(last > first, F.sequence(first + 1, last)).otherwise(F.array().cast("array<int>"))
    walked = F.aggregate(later, start, step, lambda acc: acc["all"])
    whole = F.array_repeat(lasting, (last - first + 1).cast("int"))
    return F.when(F.size(gone) == 0, whole).otherwise(walked)


def booked_at(cells: Column, lead: Column | int) -> Column:
    """Total on the books at one lead."""
    return F.aggregate(
        F.filter(cells, lambda c: c["lead"] >= _col(lead)), F.lit(0.0), lambda acc, c: acc + c["amount"]
    )


def trim_pace(pace: Column, lead_window: Column | int) -> Column:
    """Null the slots at or past the hotel's own lead window; the length stays."""
    return F.transform(pace, lambda x, i: F.when(i < _col(lead_window), x))


def running_max(path: Column) -> Column:
    return F.transform(path, lambda _, i: F.array_max(F.slice(path, F.lit(1), i + 1)))


def fill_linear(path: Column) -> Column:
    """Replace nulls by the straight line between their known neighbours; the ends copy the nearest one."""
    marks = F.filter(
        F.transform(path, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: p["x"].isNotNull()
    )

    def value(x, i):
        after = F.try_element_at(F.filter(marks, lambda p: p["i"] > i), F.lit(1))
        before = F.try_element_at(F.filter(marks, lambda p: p["i"] < i), F.lit(-1))
        line = before["x"] + (after["x"] - before["x"]) * (i - before["i"]) / (after["i"] - before["i"])
        return F.coalesce(x, line, before["x"], after["x"])

    return F.transform(path, value)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
