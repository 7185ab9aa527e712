"""Helpers shared by the operators: scratch tables in the shared folder, Arrow batches, document input."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE_BYTES = 1 << 20
WHITE_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_mine: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local session without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; what a session made is removed when it ends normally."""
    if not _mine:
        atexit.register(_remove)
    path = f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    _mine.add(path)
    return path


def _remove() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    for path in _mine:
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the JVM may be going down already; the folder then stays for the cluster's own clean-up
            return


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text alone, so that other columns, whatever their names, can't clash with an operator's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def ascii_lower(text) -> F.Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `most` bytes of text (a single longer text stays whole)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


def map_texts(
    df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch], most: int = 4 << 20
) -> DataFrame:
    """fn over Arrow batches of bounded text size. fn must be picklable; heavy state is kept by the worker."""

    def run(batches):
        for batch in small_batches(batches, most=most):
            yield fn(batch)

    return df.mapInArrow(run, schema)


def slices(text: bytes, most: int = SLICE_BYTES) -> Iterator[bytes]:
    """The text cut at white space into slices of about `most` bytes, so that a long text needs no long lists."""
    at = 0
    while len(text) - at > most:
        cut = WHITE_SPACE.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


class Recent:
    """A bounded cache of two generations: what is met moves to the young one; when that is full, the old one goes.

    So entries that are met at least once while `most` others are stay, however many pass by.
    """

    def __init__(self, most: int):
        self.most = most
        self.young: dict = {}
        self.old: dict = {}

    def turn(self) -> None:
        """Start a new generation if the young one is full. Between two turns nothing that was met is forgotten."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}

    def missing(self, keys) -> list:
        """The keys that are not held; those that are will be in `young`."""
        young, old, out = self.young, self.old, []
        for key in keys:
            if key not in young:
                found = old.get(key)
                if found is None:
                    out.append(key)
                else:
                    young[key] = found
        return out


def rows_for(total: int, each: int, least: int = 1, most: int = 100_000) -> int:
    """How many partitions of about `each` rows or bytes `total` makes."""
    return int(min(most, max(least, -(-total // each))))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join where null keys meet; the result has left's columns, then right's without its keys."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])
