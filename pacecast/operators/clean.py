"""From raw night-level bookings to rows that count: cancellations, statuses, cuts, daily sums."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacecast.config import NO_SHOW, PMS_CHANNEL


def normalise_dates(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.to_date(c) for c in columns})


def parse_timestamp(df: DataFrame, column: str, pattern: str = "yyyy-MM-dd") -> DataFrame:
    return df.withColumn(column, F.to_timestamp(F.col(column), pattern))


def attach_cancellations(bookings: DataFrame, transactions: DataFrame) -> DataFrame:
    """bookings left join transactions. A transaction id occurs once in `transactions`, so those without a
    cancellation date need not travel: a booking without a match reads null either way. One transaction
    holding very many bookings is split by adaptive skew join, as the left side may be."""
    cancelled = transactions.where(F.col("cancellation_date").isNotNull()).select("TransactionID", "cancellation_date")
    return bookings.join(cancelled, "TransactionID", "left")


BLOCK_BITS = 32_768  # bits of one row of a key filter: 4 KB
WORD_BITS = 32


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """block, words: which of `bits` places the hashes of all keys fall on, BLOCK_BITS to a row as 32-bit words.

    Its size is bits / 8 bytes at most, whatever the number of keys; more keys only make more false hits. Null keys
    are left out.
    """
    if bits < BLOCK_BITS or bits % BLOCK_BITS:
        raise ValueError(f"a filter has a multiple of {BLOCK_BITS} bits")
    at = keys.where(F.col(key).isNotNull()).select(_place(key, bits).alias("at"))
    block = F.floor(F.col("at") / BLOCK_BITS).alias("block")
    maps = at.groupBy(block).agg(F.bitmap_construct_agg(F.col("at") % BLOCK_BITS).alias("map"))
    four = lambda i: F.conv(F.hex(F.substr("map", i * 4 + 1, F.lit(4))), 16, 10).cast("long")
    signed = lambda x: F.when(x >= 1 << 31, x - (1 << 32)).otherwise(x).cast("int")
    numbers = F.sequence(F.lit(0), F.lit(BLOCK_BITS // WORD_BITS - 1))
    return maps.select("block", F.transform(numbers, lambda i: signed(four(i))).alias("words"))


def may_hold(df: DataFrame, found: DataFrame, key: str, bits: int, out: str) -> DataFrame:
    """Add `out`: whether the key may be among those of the filter. False is certain; null keys are false.

    The filter goes to every task, as its size is bounded by `bits`.
    """
    block = F.floor(_place(key, bits) / BLOCK_BITS)
    bit = _place(key, bits) % WORD_BITS  # bytes stand in file order in a word, bits of a byte from the lowest
    shift = 8 * (3 - F.floor(bit / 8)) + bit % 8
    word = F.get("_words", (F.floor(_place(key, bits) / WORD_BITS) % (BLOCK_BITS // WORD_BITS)).cast("int"))
    sent = F.broadcast(found.select(F.col("block").alias("_block"), F.col("words").alias("_words")))
    hit = F.coalesce(F.col(key).isNotNull() & (F.getbit(word, shift.cast("int")) == 1), F.lit(False))
    return df.join(sent, block == F.col("_block"), "left").withColumn(out, hit).drop("_block", "_words")


def attach_to_candidates(bookings: DataFrame, transactions: DataFrame, bits: int) -> DataFrame:
    """As attach_cancellations, but only bookings whose id may be a cancelled one meet the transactions.

    Most bookings are never cancelled. A filter of fixed size over the cancelled ids tells these apart, so they skip
    the exchange and are united back without a date. The price is a second scan of the bookings. False hits meet no
    transaction and read null as before. Pays where cancelled ids are too many to send whole, and fewer than about `bits`.
    """
    cancelled = transactions.where(F.col("cancellation_date").isNotNull()).select("TransactionID", "cancellation_date")
    marked = may_hold(bookings, key_filter(cancelled, "TransactionID", bits), "TransactionID", bits, "_may")
    met = marked.where("_may").drop("_may").join(cancelled, "TransactionID", "left")
    day = cancelled.schema["cancellation_date"].dataType
    rest = marked.where("not _may").drop("_may").withColumn("cancellation_date", F.lit(None).cast(day))
    return met.unionByName(rest)


def fill_no_show(df: DataFrame, mode: str | None = "fill_null", status: str = NO_SHOW) -> DataFrame:
    """No-shows count as cancelled on the stay date: only where no date is known, always, or (None) not at all."""
    if mode is None:
        return df
    if mode not in ("fill_null", "overwrite"):
        raise ValueError("mode must be fill_null, overwrite or None")
    hit = F.col("status") == status
    if mode == "fill_null":
        hit = hit & F.col("cancellation_date").isNull()
    return df.withColumn(
        "cancellation_date", F.when(hit, F.col("stay_date")).otherwise(F.col("cancellation_date"))
    )


def _in_scenario(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Mark each row with its status scenarios; the lookup holds a status once per scenario."""
    wide = lookup.groupBy("status").agg(
        F.max(F.col("scenario") == "confirmed").alias("_confirmed"),
        F.max(F.col("scenario") == "cancelled").alias("_cancelled"),
    )
    return df.join(wide, "status", "left")


def confirmed_only(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Status in the confirmed list and no cancellation date."""
    confirmed = lookup.where(F.col("scenario") == "confirmed").select("status").distinct()
    return df.where(F.col("cancellation_date").isNull()).join(confirmed, "status", "left_semi")


def cancel_aware(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Confirmed-only rows, or cancelled ones whose cancellation date is known and not after the stay."""
    keep = (F.col("_confirmed") & F.col("cancellation_date").isNull()) | (
        F.col("_cancelled") & (F.col("cancellation_date") <= F.col("stay_date"))
    )
    return _in_scenario(df, lookup).where(keep).drop("_confirmed", "_cancelled")


def with_status_targets(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Cancel-aware rows, and rows that count for targets alone, told apart by `target_only`.

    Targets go by status alone here: a booking of a confirmed status counts, whatever its cancellation date. Where that
    date keeps it out of the cancel-aware rows, or makes it a cancelled one there, it comes (again) as a target-only row.
    """
    lasting = F.col("_confirmed") & F.col("cancellation_date").isNull()
    gone = F.col("_cancelled") & (F.col("cancellation_date") <= F.col("stay_date"))
    late = F.col("_confirmed") & F.col("cancellation_date").isNotNull()
    roles = F.array(F.when(lasting | gone, F.lit(False)), F.when(late, F.lit(True)))
    marked = _in_scenario(df, lookup).withColumn("target_only", F.explode(F.array_compact(roles)))
    return marked.drop("_confirmed", "_cancelled")


def select_hotels(df: DataFrame, hotels: DataFrame | list[str] | None) -> DataFrame:
    """Keep selected hotels; an empty selection keeps all."""
    if hotels is None or hotels == []:
        return df
    if isinstance(hotels, list):
        return df.where(F.col("HotelID").isin(hotels))
    return df.join(hotels.select("HotelID").distinct(), "HotelID", "left_semi")


def preprocess(
    df: DataFrame,
    model_start: date | None = None,
    without_pms: bool = False,
    closed_window: tuple[date, date] | None = None,
) -> DataFrame:
    """Start cut, optional channel exclusion, optional exclusion of a closed stay window, no negative leads."""
    df = df.where(F.col("confirmation_date") <= F.col("stay_date"))
    if model_start is not None:
        df = df.where(F.col("stay_date") >= F.lit(model_start))
    if without_pms:
        df = df.where(~F.col("channel").eqNullSafe(PMS_CHANNEL))  # own rule: an unknown channel is not PMS
    if closed_window is not None:
        df = df.where(~F.col("stay_date").between(*map(F.lit, closed_window)))
    return df


def _day(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def train_cut(df: DataFrame, partition_date: date | Column) -> DataFrame:
    return df.where(F.col("stay_date") <= _day(partition_date))


def test_window(df: DataFrame, start: date | Column, end: date | Column) -> DataFrame:
    """Stays in (start, end], with the bookings known at start."""
    return df.where(
        (F.col("stay_date") > _day(start))
        & (F.col("stay_date") <= _day(end))
        & (F.col("confirmation_date") <= _day(start))
    )


def watermark(bookings: DataFrame, column: str = "confirmation_date") -> Column:
    """Latest date in the data, as a scalar subquery: no action, and Spark can prune with it."""
    return bookings.agg(F.max(column)).scalar()


def daily_net(df: DataFrame, with_cancellation: bool = False) -> DataFrame:
    keys = ["HotelID", "stay_date", "confirmation_date"] + (["cancellation_date"] if with_cancellation else [])
    return df.groupBy(*keys).agg(F.sum("revenue").alias("revenue"), F.sum("rooms").alias("rooms"))


def attach_config(df: DataFrame, config: DataFrame, *columns: str) -> DataFrame:
    """Add per-hotel settings. The planner broadcasts the config by its measured size, or shuffles it."""
    picked = config.select("HotelID", *columns) if columns else config
    return df.join(picked, "HotelID", "inner")
