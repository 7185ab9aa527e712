"""N-gram Jaccard join: documents whose sets of word shingles reach a Jaccard similarity, by a grouped prefix join.

A document's set holds its distinct word shingles (fewer words: the whole sequence as one member). Two documents are
linked when 100 * intersection >= percent * union; a component is what links reach.

1. Every text is read once into its set, kept as sorted 64-bit hashes (two shingles meet in one hash with probability
   2**-64; counts and tests are exact over hashes). Rows of equal sets are one entry from here on.
2. Members are ordered by rarity: exact counts over all documents in `buckets` hash buckets (bounded, so they may go to
   every task), then by hash. Any one order gives the same links; a rare one few candidates. Sets that reach the
   similarity share a member of their prefixes, at places that leave enough members behind for the overlap.
3. Entries of identical prefix and size collapse into one group. Only groups are joined on prefix members that more
   than one group has (and a group with itself, if it has several entries); sizes and places decide before any member of
   a group is looked at.
4. First each group's members are verified against its first member, and groups against a few groups of nearly their
   size under each shared prefix member: a linear number of pairs, which joins clumps of near copies.
5. What is linked so far is a class. Pairs of classes that still share a prefix member are filtered by size and place,
   expanded to their members, and verified. Pairs within a component are never formed, so a clump of copies makes no
   square, and no link between two components is lost.

Empty and null texts have an empty set and are linked with nothing, themselves apart. Rows with null doc_id take part;
a component of such rows alone has a null component_id. Repeated rows share a component (with a non-empty set). An
empty table gives no rows. A long text is hashed in slices; its set is 8 bytes a shingle. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacecast.llm.common import map_texts, slices, staged, texts_of
from pacecast.llm.simhash import NO_ID, SEED, UPPER_TO_LOWER, components

SHINGLE, PERCENT = 3, 90
LEAST_BUCKETS, MOST_BUCKETS, RUN = 1 << 16, 1 << 20, 1 << 12
MOST_WORDS = 200_000
HEADS, FEW = 1, 4
SENT_IDS = 1_000_000
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD)]
SET_SCHEMA = "doc_id long, k1 long, k2 long, n long, members array<long>"
PREFIX_SCHEMA = "k1 long, k2 long, n long, row long, p1 long, p2 long, prefix array<long>"


class WordHashes(dict):
    """word -> hash; emptied when it is full, which only costs hashing again."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return found


def shingle_set(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles, as signed numbers."""
    parts = []
    for piece in slices(text):
        words = piece.translate(UPPER_TO_LOWER).split()  # bytes: exactly the ASCII white space
        parts.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
    words = np.concatenate(parts)
    if not len(words):
        return np.zeros(0, np.int64)
    size = min(size, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):  # each word enters by its place, so that the order counts
        mixed = (mixed ^ words[i : len(words) - size + 1 + i]) * MIX[i % 3]
        mixed ^= mixed >> np.uint64(32)
    mixed *= MIX[3]
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed.view(np.int64))


def digest(members: np.ndarray) -> tuple[int, int]:
    """128 bits of a hash run, as two signed numbers."""
    high, low = np.frombuffer(xxhash.xxh3_128_digest(members.tobytes()), ">i8")
    return int(high), int(low)


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def shingle_sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """A row a document: doc_id, 128-bit key of its set, set size, sorted member hashes."""
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(t or b"", size, hashes) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        keys = np.array([digest(s) for s in found], np.int64).reshape(-1, 2)
        columns = [batch.column("doc_id"), keys[:, 0], keys[:, 1], np.array([len(s) for s in found], np.int64)]
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, columns), lists(found)], names=["doc_id", "k1", "k2", "n", "members"]
        )

    return map_texts(texts_of(docs), SET_SCHEMA, run)


def each_list(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
    values = batch.column(column)
    return np.split(values.flatten().to_numpy(), np.cumsum(pa.compute.list_value_length(values).to_numpy())[:-1])


def bucket_of(members: np.ndarray, buckets: int) -> np.ndarray:
    return (members.view(np.uint64) >> np.uint64(64 - (buckets - 1).bit_length())).astype(np.int64)


def bucket_counts(sets: DataFrame, buckets: int) -> np.ndarray:
    """How many set members of all documents fall in each bucket. The driver gets them in runs of RUN buckets."""
    counts = "run int, counts array<long>"

    def rows(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for run in np.flatnonzero(total.reshape(-1, RUN).any(axis=1)):
            part = lists([total[run * RUN : (run + 1) * RUN]])
            yield pa.RecordBatch.from_arrays([pa.array([run], pa.int32()), part], names=["run", "counts"])

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(bucket_of(batch.column("members").flatten().to_numpy(), buckets), minlength=buckets)
        yield from rows(total)

    def add(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for run, part in zip(batch.column("run").to_pylist(), each_list(batch, "counts") if batch.num_rows else []):
                total[run * RUN : (run + 1) * RUN] += part
        yield from rows(total)

    summed = sets.select("members").mapInArrow(count, counts).repartition("run").mapInArrow(add, counts)
    out = np.zeros(buckets, np.int64)
    for row in summed.toLocalIterator():
        out[row["run"] * RUN : (row["run"] + 1) * RUN] = row["counts"]
    return out


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Places of the rarest members among which a set of n meets every set within reach."""
    return n - -(-percent * n // 100) + 1


def prefixes(sets: DataFrame, counts: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """The rarest members of every non-empty set in order, and a 128-bit key of them."""
    buckets = len(counts)

    def run(batches):
        for batch in batches:
            found = []
            for members in each_list(batch, "members") if batch.num_rows else []:
                order = np.argsort(counts[bucket_of(members, buckets)], kind="stable")  # members are sorted by hash
                found.append(members[order[: prefix_length(len(members), percent)]])
            keys = np.array([digest(p) for p in found], np.int64).reshape(-1, 2)
            kept = [batch.column(c) for c in ("k1", "k2", "n", "row")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(keys[:, 0]), pa.array(keys[:, 1]), lists(found)],
                names=["k1", "k2", "n", "row", "p1", "p2", "prefix"],
            )

    full = sets.where("n > 0").select("k1", "k2", "n", "row", "members")
    return full.mapInArrow(run, PREFIX_SCHEMA)


def overlap(n: str, m: str, percent: int) -> str:
    """Least intersection of two sets of n and m members within reach."""
    return f"(({percent} * ({n} + {m}) + {100 + percent - 1}) div {100 + percent})"


def within_reach(a: str, b: str, percent: int) -> F.Column:
    """Size and place filter of two groups that share a prefix member: enough members can follow on both sides."""
    most = overlap(f"{a}.n", f"{b}.n", percent)
    return F.expr(f"{a}.n - {a}.at >= {most} and {b}.n - {b}.at >= {most}")


def asked(rows: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """The rows that a table of pairs (a, b) names. Up to SENT_IDS names (16 MB) are sent to where the rows lie, so that
    only these rows move; beyond, rows and names are shuffled."""
    names = pairs.select(F.col("a").alias(key)).unionByName(pairs.select(F.col("b").alias(key))).distinct()
    few = 2 * pairs.count() <= SENT_IDS
    return rows.join(F.broadcast(names) if few else names, key, "left_semi")


def verified(pairs: DataFrame, entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of entries whose sets reach the similarity, as a table.

    Prefixes are longer than one shared member needs. What two sets share beyond them is at most what the set of the
    earlier ending prefix has left, so so many members must be shared within the prefixes; only pairs that pass this are
    verified over their whole sets, and only these sets are read.
    """
    pairs = staged(pairs, "pairs")
    held = staged(asked(entries.select("id", "n", "prefix"), "id", pairs), "prefixes")
    one = held.select(F.col("id").alias("a"), F.struct("n", "prefix").alias("x"))
    other = held.select(F.col("id").alias("b"), F.struct("n", "prefix").alias("y"))
    common = F.size(F.array_intersect("x.prefix", "y.prefix"))
    left = F.greatest(F.col("x.n") - F.size("x.prefix"), F.col("y.n") - F.size("y.prefix"))
    enough = common >= F.expr(overlap("x.n", "y.n", percent)) - left
    likely = staged(pairs.join(one, "a").join(other, "b").where(enough).select("a", "b"), "likely")

    live = staged(asked(sets.select(F.col("row").alias("id"), "members"), "id", likely), "live")
    one = live.select(F.col("id").alias("a"), F.col("members").alias("m"))
    other = live.select(F.col("id").alias("b"), F.col("members").alias("o"))
    met = likely.join(one, "a").join(other, "b").select(
        "a", "b", F.size(F.array_intersect("m", "o")).cast("long").alias("c"), (F.size("m") + F.size("o")).cast("long").alias("sizes")
    )
    return staged(met.where(F.expr(f"100 * c >= {percent} * (sizes - c)")).select("a", "b"), "links")


def star_pairs(entries: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """Each entry with its group's first one; each group with the heads among those it shares a prefix member with.

    Up to FEW groups are all heads. Of more, heads are the group of each size band that has most shared places (the text
    that a clump of near copies comes from has no members of its own) and, by a hash of the group alone, about HEADS more,
    mostly the same ones under all the members that a clump shares.
    """
    own = entries.where("id <> gid").select(F.col("id").alias("a"), F.col("gid").alias("b"))
    band = F.floor(F.log("n") / F.log(F.lit(100.0 / percent))) if percent < 100 else F.col("n")
    crowded = places.where(F.col("groups") > FEW)
    kept = crowded.groupBy("gid").agg(F.count(F.lit(1)).alias("held"))
    most = F.max(F.struct("held", F.xxhash64("gid").alias("h"), "gid", "n", "at")).alias("h")
    central = crowded.join(kept, "gid").groupBy("token", band.alias("band")).agg(most).select("token", "h.gid", "h.n", "h.at")
    lot = F.pmod(F.xxhash64("gid"), F.lit(1 << 20)) * F.col("groups") < HEADS << 20
    heads = central.unionByName(places.where((F.col("groups") <= FEW) | lot).select("token", "gid", "n", "at"))
    met = places.alias("g").join(heads.alias("h"), "token")
    met = met.where(F.col("g.gid") != F.col("h.gid")).where(within_reach("g", "h", percent))
    met = met.select(F.greatest("g.gid", "h.gid").alias("a"), F.least("g.gid", "h.gid").alias("b"))
    return own.unionByName(met).distinct()


def class_pairs(classes: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """Pairs of entries from different components whose groups share a prefix member within reach.

    classes: id, gid, root. A group's entries of one root are one class; components are paired first, by the sizes and
    places that they hold under a member, then their classes, then the entries of these.
    """
    kinds = classes.select("gid", "root").distinct()
    # Where few groups of one entry each meet, all their pairs are verified already.
    held = places.where((F.col("groups") > FEW) | (F.col("widest") > 1)).join(kinds, "gid")
    heads = held.groupBy("token", "root").agg(F.min("n").alias("least"), F.max("n").alias("n"), F.max(F.col("n") - F.col("at")).alias("rest"))
    several = heads.groupBy("token").agg(F.count(F.lit(1)).alias("roots")).where("roots > 1").select("token")
    heads, held = heads.join(several, "token"), held.join(several, "token")
    close = F.expr(
        f"x.root < y.root and 100 * x.n >= {percent} * y.least and 100 * y.n >= {percent} * x.least "
        f"and least(x.rest, y.rest) >= {overlap('x.least', 'y.least', percent)}"
    )
    met = heads.alias("x").join(heads.alias("y"), F.expr("x.token = y.token") & close)
    met = met.select("x.token", F.col("x.root").alias("ra"), F.col("y.root").alias("rb"))
    left = held.select("token", F.col("root").alias("ra"), F.struct("gid", "n", "at").alias("g"))
    right = held.select("token", F.col("root").alias("rb"), F.struct("gid", "n", "at").alias("h"))
    groups = met.join(left, ["token", "ra"]).join(right, ["token", "rb"]).where(within_reach("g", "h", percent))
    groups = groups.select(F.col("g.gid").alias("ga"), "ra", F.col("h.gid").alias("gb"), "rb").distinct()
    ones = classes.select(F.col("gid").alias("ga"), F.col("root").alias("ra"), F.col("id").alias("a"))
    others = classes.select(F.col("gid").alias("gb"), F.col("root").alias("rb"), F.col("id").alias("b"))
    return groups.join(ones, ["ga", "ra"]).join(others, ["gb", "rb"]).select("a", "b")


def with_roots(entries: DataFrame, links: DataFrame) -> DataFrame:
    """entries with the smallest entry of their component."""
    found = components(links)
    return entries.join(found, entries["id"] == found["node"], "left").select(
        entries["*"], F.coalesce("root", "id").alias("root")
    )


def similar(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, buckets: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach) and n_copies (rows of the same set)."""
    if not 0 < percent <= 100:
        raise ValueError("percent must lie in 1 to 100")
    sets = staged(shingle_sets(docs, size).withColumn("row", F.monotonically_increasing_id()), "sets")
    if buckets is None:
        total = sets.agg(F.sum("n")).first()[0] or 0
        buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << (total >> 4).bit_length()))
    counts = bucket_counts(sets, buckets)
    ordered = staged(prefixes(sets, counts, percent), "prefixes")
    first = F.min(F.struct("row", "n", "p1", "p2")).alias("f")
    entries = ordered.groupBy("k1", "k2").agg(first)
    entries = staged(entries.select("k1", "k2", F.col("f.row").alias("id"), "f.n", "f.p1", "f.p2"), "entries")
    ordered = ordered.select(F.col("row").alias("id"), "n", "prefix")

    groups = staged(
        entries.groupBy("n", "p1", "p2").agg(F.min("id").alias("gid"), F.count(F.lit(1)).alias("entries")), "groups"
    )
    members = entries.select("id", "n", "p1", "p2").join(groups, ["n", "p1", "p2"]).select("id", "gid")
    heads = groups.select(F.col("gid").alias("id"), "entries")
    firsts = ordered.join(F.broadcast(heads) if groups.count() <= SENT_IDS else heads, "id")
    places = firsts.select(F.col("id").alias("gid"), "n", "entries", F.posexplode("prefix").alias("at", "token"))
    shared = places.groupBy("token").agg(F.count(F.lit(1)).alias("groups"), F.max("entries").alias("widest")).where("groups > 1")
    # A group of several entries keeps one place at least, where its own classes meet.
    places = places.join(shared, "token", "left").where("groups > 1 or (at = 0 and entries > 1)")
    groups_of, widest = F.coalesce("groups", F.lit(1)).alias("groups"), F.coalesce("widest", "entries").alias("widest")
    places = staged(places.select("token", "gid", "n", "at", groups_of, widest), "places")
    classes = staged(members.join(places.select("gid").distinct(), "gid", "left_semi"), "classes")
    links = verified(star_pairs(classes, places, percent), ordered, sets, percent)
    rooted = staged(with_roots(classes, links), "rooted")
    more = verified(class_pairs(rooted, places, percent), ordered, sets, percent)

    joined = with_roots(entries.select("k1", "k2", "id"), links.unionByName(more))
    named = sets.where("n > 0").groupBy("k1", "k2").agg(
        F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    named = staged(named.join(joined, ["k1", "k2"]).select("k1", "k2", "root", "first", "copies"), "named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    placed = named.join(smallest, "root").select("k1", "k2", "component", "copies")
    out = sets.select("doc_id", "k1", "k2", "n").join(placed, ["k1", "k2"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("component") != NO_ID, F.col("component"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce("copies", F.lit(1)).alias("n_copies")
    )
