"""Calendar and lag features, and the choice of features for each forecast distance."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacecast.functions import arrays as A
from pacecast.functions.dates import CALENDAR_FEATURES, calendar_features
from pacecast.operators.pace import KEYS, split_cells


def _holiday_marks(holidays: DataFrame) -> DataFrame:
    return holidays.select(
        F.col("date").alias("stay_date"), "Country", "State", F.lit(True).alias("_off")
    ).distinct()


def region_calendar(hotels: DataFrame, start: date | Column, end: date | Column, holidays: DataFrame) -> DataFrame:
    """Calendar table of every region that a hotel lies in; days are generated, not crossed."""
    start, end = (d if isinstance(d, Column) else F.lit(d) for d in (start, end))
    regions = hotels.select("Country", "State").distinct().where(F.col("Country").isNotNull())
    days = regions.select("Country", "State", F.explode(F.sequence(start, end)).alias("stay_date"))
    marked = days.join(_holiday_marks(holidays), ["stay_date", "Country", "State"], "left")
    features = calendar_features(F.col("stay_date"), F.coalesce(F.col("_off"), F.lit(False)))
    return marked.select("stay_date", "Country", "State", *features.values())


def hotel_calendar(calendar: DataFrame, hotels: DataFrame) -> DataFrame:
    """Calendar rows of each hotel, by country and state; a null country matches nothing.

    Hotels are spread over the calendar's days before the join, so the day is part of its key: a region with
    very many hotels is then shared by many tasks.
    """
    span = calendar.agg(F.min("stay_date").alias("a"), F.max("stay_date").alias("b"))
    days = F.sequence(span.select("a").scalar(), span.select("b").scalar())
    nights = hotels.where(F.col("Country").isNotNull()).select(
        "HotelID", "Country", "State", F.explode(days).alias("stay_date")
    )
    return nights.join(calendar, ["Country", "State", "stay_date"], "inner")


def with_calendar(stays: DataFrame, hotels: DataFrame, holidays: DataFrame) -> DataFrame:
    """Calendar features put on existing stays.

    All but the holiday mark are functions of the date, so no hotel x day table is built or joined: only the
    hotel's region and the holidays are looked up. Hotels without a country get nulls, as with the table.
    """
    places = hotels.select("HotelID", "Country", "State")
    placed = stays.join(places, "HotelID", "left")
    marked = placed.join(_holiday_marks(holidays), ["stay_date", "Country", "State"], "left")
    features = calendar_features(F.col("stay_date"), F.coalesce(F.col("_off"), F.lit(False)))
    known = {n: F.when(F.col("Country").isNotNull(), c) for n, c in features.items()}
    return marked.withColumns(known).drop("_off", "Country", "State")


def lag_totals(totals: DataFrame, value: str, lags) -> DataFrame:
    """lag{n} of a stay = final total of the stay n calendar days earlier.

    Each total is sent to the stays it is a lag of and grouped there: one shuffle for all lags, and stays
    without bookings of their own still get lags.
    """
    sent = totals.select(
        "HotelID", F.col("stay_date").alias("_from"), F.col(value).alias("_v"), F.explode(F.lit(list(lags))).alias("_n")
    ).select("HotelID", F.date_add("_from", F.col("_n")).alias("stay_date"), "_n", "_v")
    return sent.groupBy(*KEYS).agg(*[F.max(F.when(F.col("_n") == n, F.col("_v"))).alias(f"lag{n}") for n in lags])


def days_ahead(df: DataFrame, partition_date: date | Column) -> DataFrame:
    when = partition_date if isinstance(partition_date, Column) else F.lit(partition_date)
    return df.withColumn("day_ahead", F.datediff("stay_date", when))


def _lags_beyond(lags, distance: Column) -> Column:
    """Lags longer than the distance, in given order; a missing lag reads 0."""
    pairs = F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"lag{n}").cast("double").alias("v")) for n in lags])
    return F.transform(F.filter(pairs, lambda p: p["n"] > distance), lambda p: F.coalesce(p["v"], F.lit(0.0)))


def _vector(df: DataFrame, pace: Column, lags, distance: Column) -> Column:
    """Feature vector: pace, lags longer than the distance, calendar; unknown values read 0."""
    calendar = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in CALENDAR_FEATURES if c in df.columns]
    parts = [F.transform(pace, lambda x: F.coalesce(x, F.lit(0.0)))]
    if lags:
        parts.append(_lags_beyond(lags, distance))
    if calendar:
        parts.append(F.array(*calendar))
    return F.concat(*parts)


def _near_targets(d: Column) -> Column:
    return F.reverse(F.slice("target", F.lit(1), d))


def _seen(d: Column, n_pace: int | None, max_lead: int | None = None) -> Column:
    """Pace slots known d days ahead: leads d, d+1, ... up to a count or a last lead."""
    last = F.size("pace") if max_lead is None else F.least(F.size("pace"), F.lit(max_lead + 1))
    width = last - d if n_pace is None else F.least(last - d, F.lit(n_pace))
    return F.slice("pace", d + 1, F.greatest(width, F.lit(0)))


def near_field_rows(
    matrix: DataFrame, horizon: int, lags=(), n_pace: int | None = None, snapshot_offset: int = 1
) -> DataFrame:
    """Model rows for every distance d in 1..horizon, read off the snapshot d - snapshot_offset.

    `y` = targets at leads d-1 .. 0 in path order, `base` = pace at lead d, `x` = pace from lead d on
    (the first n_pace of it), lags longer than d, calendar. Offset 1 is what existing jobs read; at offset 0
    no cancellation after the forecast origin can be seen.
    """
    d = F.col("forecast_index") + snapshot_offset
    return matrix.where(d.between(1, horizon)).select(
        *KEYS,
        d.alias("day_ahead"),
        _near_targets(d).alias("y"),
        F.get("pace", d).alias("base"),
        _vector(matrix, _seen(d, n_pace), lags, d).alias("x"),
    )


def far_field_rows(matrix: DataFrame, points, step: int, lags=(), max_lead: int | None = None) -> DataFrame:
    """Model rows for the far points p: one target at lead p - step, pace from lead p, snapshot p."""
    p = F.col("forecast_index")
    return matrix.where(p.isin(list(points))).select(
        *KEYS,
        p.alias("day_ahead"),
        F.array(F.get("target", p - step)).alias("y"),
        F.get("pace", p).alias("base"),
        _vector(matrix, _seen(p, None, max_lead), lags, p).alias("x"),
    )


def inference_rows(matrix: DataFrame, lags=(), n_pace: int | None = None, keep=()) -> DataFrame:
    """Model rows to forecast, from a matrix that already knows its `day_ahead`."""
    d = F.col("day_ahead")
    return matrix.select(
        *KEYS, "day_ahead", *keep, F.get("pace", d).alias("base"), _vector(matrix, _seen(d, n_pace), lags, d).alias("x")
    )


def rows_from_cells(
    stays: DataFrame,
    distances,
    lead_window: int,
    lags=(),
    n_pace: int | None = None,
    snapshot_offset: int = 1,
    far_step: int | None = None,
    keep=(),
) -> DataFrame:
    """Same rows as near_field_rows / far_field_rows, straight from cells and targets.

    Only the asked-for distances (a list, or an array column) are exploded, and only the slots that a distance
    may see are worked out.
    """
    d = F.col("day_ahead")
    k = d - snapshot_offset
    top = F.lit(lead_window) if n_pace is None else F.least(d + n_pace, F.lit(lead_window))
    y = _near_targets(d) if far_step is None else F.array(F.get("target", d - far_step))
    wanted = distances if isinstance(distances, Column) else F.lit(list(distances))
    lasting, gone = F.col("lasting"), F.col("gone")
    # One fold gives all snapshots from the first to the last that a wanted distance reads.
    low, high = F.array_min("_wanted") - snapshot_offset, F.array_max("_wanted") - snapshot_offset
    held = split_cells(stays, lead_window).withColumn("_wanted", wanted).where(F.size("_wanted") > 0)
    held = held.withColumn("_first", low).withColumn("_snapshots", A.snapshots_between(lasting, gone, low, high))
    spread = held.withColumn("day_ahead", F.explode("_wanted"))
    own = F.get("_snapshots", k - F.col("_first"))
    seen = F.slice(own, (d + 1).cast("int"), F.greatest(top - d, F.lit(0)).cast("int"))
    if "lead_window" in stays.columns:  # a hotel's own window: farther slots read 0, as they do at inference
        seen = A.trim_pace(seen, F.col("lead_window") - d)
    return spread.select(
        *KEYS,
        "day_ahead",
        *keep,
        y.alias("y"),
        F.get(own, d).alias("base"),
        _vector(stays, seen, lags, d).alias("x"),
    )


def horizon_split(df: DataFrame, horizon: int, lengths: DataFrame | None = None) -> DataFrame:
    """Mark the last `horizon` days of each hotel as test. The per-hotel maximum is a small aggregate joined
    back, so no task has to hold a whole hotel. `lengths` (HotelID, training_length) gives hotels a number of
    their own; a hotel it does not name keeps `horizon`."""
    last = df.groupBy("HotelID").agg(F.max("stay_date").alias("test_end"))
    days = F.lit(horizon)
    if lengths is not None:
        last = last.join(lengths.select("HotelID", "training_length"), "HotelID", "left")
        days = F.coalesce(F.col("training_length").cast("int"), days)
    last = last.select("HotelID", F.date_sub("test_end", days).alias("test_start"), "test_end")
    return df.join(last, "HotelID").select(
        *df.columns, "test_start", "test_end", (F.col("stay_date") >= F.col("test_start")).alias("is_test")
    )
