"""Error report over log files, in one job for all files."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The text that failing hotels write to the log.
ERROR_TEXT = "Error encountered when processing hotel"
ERROR_PATTERN = r"Error encountered when processing hotel ([^:]+): (.*)"
NAMED = 20
TIME_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"


def error_lines(
    lines: DataFrame, text: str = ERROR_TEXT, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Lines that hold `text`, with hotel and message; a time range is read off the line itself."""
    stamp = F.try_to_timestamp(F.regexp_extract("value", TIME_PATTERN, 1), F.lit("yyyy-MM-dd HH:mm:ss"))
    hits = lines.where(F.col("value").contains(text)).select(
        "file",
        stamp.alias("logged_at"),
        F.regexp_extract("value", ERROR_PATTERN, 1).alias("HotelID"),
        F.regexp_extract("value", ERROR_PATTERN, 2).alias("message"),
        "value",
    )
    if start is not None:
        hits = hits.where(F.col("logged_at") >= F.lit(start))
    if end is not None:
        hits = hits.where(F.col("logged_at") <= F.lit(end))
    return hits


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of lines of one record and block, summed up: those whose first line is a hit, and those without a first line.

    `place` counts the record starts of the block up to the run, 0 above the first one; `line` is the run's last line.
    A run that goes on in the next batch has its rest there, without a first line, under the same place.
    """
    at, lines, starts = None, 0, 0
    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        file, block = batch.column("file"), pc.fill_null(batch.column("block"), -1).to_numpy()
        first, filled, hit = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("starts", "filled", "hit"))
        names = file.dictionary_encode("encode").indices.to_numpy()
        new = np.ones(size, bool)
        new[1:] = (names[1:] != names[:-1]) | (block[1:] != block[:-1])
        if at == (file[0].as_py(), block[0]):
            new[0] = False
        else:
            lines = starts = 0
        own = np.cumsum(new)  # 0: the block that the last batch ended in
        began = np.concatenate([[-lines], np.flatnonzero(new)])[own]
        line = np.arange(size) - began + 1
        counted = np.cumsum(first)
        before = np.concatenate([[-starts], (counted - first)[new]])[own]
        place = counted - before

        head = first | new
        head[0] = True
        cuts = np.flatnonzero(head)
        ends = np.append(cuts[1:], size) - 1
        below = ends - cuts + 1 - first[cuts]
        last = np.maximum.reduceat(np.where(filled & ~first, np.arange(size), -1), cuts)
        at, lines, starts = (file[size - 1].as_py(), block[-1]), int(line[-1]), int(place[-1])

        kept = hit[cuts] | ~first[cuts]
        cuts, ends, below, last = cuts[kept], ends[kept], below[kept], last[kept]
        value = batch.column("value")
        yield pa.RecordBatch.from_arrays(
            [
                file.take(pa.array(cuts)),
                batch.column("block").take(pa.array(cuts)),
                pa.array(place[cuts]),
                pa.array(line[ends]),
                value.take(pa.array(cuts, mask=~first[cuts])),
                pa.array(below.astype(np.int64)),
                value.take(pa.array(last, mask=last < 0)),
            ],
            names=["file", "block", "place", "line", "value", "n_below", "last_below"],
        )


def log_records(blocks: DataFrame, text: str = ERROR_TEXT) -> DataFrame:
    """file, value, n_below, last_below: records whose first line holds `text`, with the number of lines below it (a
    trace, say) and the last of them that is not empty.

    A record starts at a line with a time stamp and goes on to the next one. A file is read in blocks by many tasks, so
    a trace may begin in one block and end in a later one: each block counts its own record starts, and lines above a
    block's first start belong to the last start of the nearest earlier block that has one, which a small table of
    the blocks tells. No task sees more than its blocks, and a task sums up its lines by record before they move: records
    that hold `text`, and the lines above a block's first start, are all that does. Lines above a file's first record
    belong to none.
    """
    starts = F.coalesce(F.col("value").rlike(TIME_PATTERN), F.lit(False)).alias("starts")
    filled = F.coalesce(F.trim("value") != "", F.lit(False)).alias("filled")
    hit = (starts & F.col("value").contains(text)).alias("hit")
    pieces = blocks.select("file", "block", starts, filled, hit, "value").mapInArrow(
        _pieces, "file string, block long, place long, line long, value string, n_below long, last_below string"
    )
    # Starts are counted off the lines themselves, so this table and the lines agree however the blocks are dealt out.
    ends = blocks.select("file", "block", starts).groupBy("file", "block").agg(F.count_if("starts").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.struct(F.col("block").alias("home"), F.col("n").alias("place"))
    carried = ends.select("file", "block", F.last(F.when(F.col("n") > 0, owner), ignorenulls=True).over(earlier).alias("before"))
    own = F.struct(F.col("block").alias("home"), "place")
    placed = pieces.join(carried, ["file", "block"], "left")
    placed = placed.withColumn("record", F.when(F.col("place") > 0, own).otherwise(F.col("before")))
    at = F.struct("block", "line")
    records = placed.where(F.col("record").isNotNull()).groupBy("file", "record").agg(
        F.max("value").alias("value"),
        F.sum("n_below").alias("n_below"),
        F.max_by("last_below", F.when(F.col("last_below").isNotNull(), at)).alias("last_below"),
    )
    return records.where(F.col("value").isNotNull()).select("file", "value", "n_below", "last_below")


def error_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("file").agg(F.count("*").alias("errors"))


def fail_on_errors(hits: DataFrame) -> None:
    """Raise if any file holds an error. The message counts all files and names the worst NAMED; error_counts lists all."""
    counts = error_counts(hits)
    worst = counts.orderBy(F.desc("errors"), "file").limit(NAMED).collect()
    if worst:
        named = ", ".join(f"{r.file} ({r.errors})" for r in worst)
        raise RuntimeError(f"errors in {counts.count()} log files, the worst: {named}")
