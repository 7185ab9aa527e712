"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints: 64 bits over the XXH64 hashes (seed 42) of a text's word shingles, a bit set where more than half the
hashes set it. Documents whose fingerprints differ in at most `most` bits are linked; a component is what links reach.

Equal fingerprints are one entry. The distinct fingerprints, sorted by Gray rank, are cut into nodes of equal count.
Neighbours in Gray order share bits, so a node is described by a mask of the bits that all its members share and their
pattern. A fingerprint goes to each later node whose pattern it meets within `most` bits: two fingerprints within reach
always meet in the later one's node. Inside a node the same is done again with two further levels (groups of GROUP and
LEAF entries): upper levels hold the bits that the whole group shares, lower ones only the bits newly shared, and the
differences add up on the way down; a group whose sum passes `most` is left out whole. Leaves compare exactly. No link is lost.

Node descriptions are the only thing all tasks get: at most MOST_NODES rows. Visitors of a node are dealt over as many
tasks as they fill. Only a spanning set of links leaves a task; components are then joined by repeated minimum
exchange between tables in the shared folder.

Null and empty texts have fingerprint zero and are linked like others. Rows with null doc_id take part; a component
of such rows alone has a null component_id. Repeated rows share a component. An empty table gives no rows. A long text
is hashed in slices and its bits are summed in blocks, so that it needs little more memory than itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacecast.llm.common import map_texts, rows_for, slices, staged, texts_of

SHINGLE, MOST_BITS, SEED = 3, 2, 42
NODE_ROWS, MOST_NODES = 100_000, 4096
TASK_VISITORS = 200_000
GROUP, LEAF = 256, 16
SLICE_BYTES, BLOCK = 1 << 18, 4096
NO_ID = (1 << 63) - 1
UPPER_TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: bytes, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Hashes of the space-joined shingles, repeats included, block by block; fewer words: the whole sequence."""
    digest, held, found = xxhash.xxh64_intdigest, [], False
    for piece in slices(text, SLICE_BYTES):
        words = held + piece.translate(UPPER_TO_LOWER).split()  # bytes: exactly the ASCII white space
        if len(words) < size:
            held = words
            continue
        joined, starts, at = b" ".join(words), [], 0
        for w in words:
            starts.append(at)
            at += len(w) + 1
        starts.append(at)
        hashes = (digest(joined[s : e - 1], SEED) for s, e in zip(starts, starts[size:]))
        yield np.fromiter(hashes, np.uint64, len(words) - size + 1)
        held, found = words[len(words) - size + 1 :], True
    if held and not found:
        yield np.array([digest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """64 bits, unsigned: those that more than half the hashes set. Bits are summed in blocks, whatever the length."""
    sums, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, size):
        for at in range(0, len(hashes), BLOCK):
            part = hashes[at : at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
            sums += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * sums > n).tobytes(), "big") if n else 0


def fingerprints_of(texts: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Signed 64-bit fingerprints."""
    return np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, fp (signed)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(fingerprints_of(texts, size))], names=["doc_id", "fp"]
        )

    return map_texts(texts_of(docs), "doc_id long, fp long", run, most=1 << 20)


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the reflected Gray sequence, as unsigned numbers."""
    rank = fp.view(np.uint64).copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _gray_column(fp: str) -> F.Column:
    """Gray rank in the order of signed numbers: the top bit is flipped."""
    rank = F.col(fp)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def shared_bits(fp: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mask, pattern) of each run of fingerprints that begins at `starts`."""
    ones = np.bitwise_and.reduceat(fp, starts)
    mask = ~(ones ^ np.bitwise_or.reduceat(fp, starts))
    return mask, ones & mask


class GrayIndex:
    """Residents in Gray order below two levels of groups; search adds up differing bits level by level."""

    def __init__(self, residents: np.ndarray):
        fp = residents.view(np.uint64)
        self.fp = fp[np.argsort(gray_rank(fp), kind="stable")]
        n = len(self.fp)
        self.leaf_starts = np.arange(0, n, LEAF)
        self.group_starts = np.arange(0, n, GROUP)
        self.group_mask, self.group_bits = shared_bits(self.fp, self.group_starts)
        mask, bits = shared_bits(self.fp, self.leaf_starts)
        above = self.group_mask[np.arange(len(mask)) // (GROUP // LEAF)]
        self.leaf_mask, self.leaf_bits = mask & ~above, bits & ~above
        self.known = mask  # bits decided above a leaf's members

    def search(self, queries: np.ndarray, most: int, block: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query places, resident places) of all pairs within `most` bits, block by block."""
        q = queries.view(np.uint64)
        per_group, n = GROUP // LEAF, len(self.fp)
        for at in range(0, len(q), block):
            part = q[at : at + block]
            first = np.bitwise_count((part[:, None] ^ self.group_bits) & self.group_mask)
            who, group = np.nonzero(first <= most)
            for cut in range(0, len(who), 1 << 16):
                w, g = who[cut : cut + (1 << 16)], group[cut : cut + (1 << 16)]
                spent = first[w, g]
                leaf = (g[:, None] * per_group + np.arange(per_group)).ravel()
                w, spent = np.repeat(w, per_group), np.repeat(spent, per_group)
                real = leaf < len(self.leaf_starts)
                w, leaf, spent = w[real], leaf[real], spent[real]
                spent = spent + np.bitwise_count((part[w] ^ self.leaf_bits[leaf]) & self.leaf_mask[leaf])
                near = spent <= most
                w, leaf, spent = w[near], leaf[near], spent[near]
                member = (leaf[:, None] * LEAF + np.arange(LEAF)).ravel()
                w, spent, known = np.repeat(w, LEAF), np.repeat(spent, LEAF), np.repeat(self.known[leaf], LEAF)
                real = member < n
                w, member, spent, known = w[real], member[real], spent[real], known[real]
                close = spent + np.bitwise_count((part[w] ^ self.fp[member]) & ~known) <= most
                yield at + w[close], member[close]


def spanning_links(queries: np.ndarray, residents: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, root fp) that join all pairs within reach between queries and residents, one a fingerprint at most."""
    index = GrayIndex(residents)
    fp = np.concatenate([queries.view(np.uint64), index.fp])
    parent = np.arange(len(fp))
    for a, b in index.search(queries, most):
        b = b + len(queries)
        while True:  # hook the larger root under the smaller until this block's pairs agree
            pa_, pb = parent[a], parent[b]
            apart = pa_ != pb
            if not apart.any():
                break
            a, b, pa_, pb = a[apart], b[apart], pa_[apart], pb[apart]
            np.minimum.at(parent, np.maximum(pa_, pb), np.minimum(pa_, pb))
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
    linked = np.flatnonzero((parent != np.arange(len(fp))) & (fp != fp[parent]))
    return fp[linked].view(np.int64), fp[parent[linked]].view(np.int64)


def _nodes(distinct: DataFrame, n: int, node_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower Gray bounds of the nodes, and their masks and patterns: MOST_NODES rows at most come to the driver."""
    count = rows_for(n, node_rows, most=MOST_NODES)
    bounds = []
    if count > 1:
        quantiles = F.percentile_approx("rank", [i / count for i in range(1, count)], max(10_000, 20 * count))
        bounds = sorted(set(distinct.agg(quantiles.alias("b")).first()["b"]))
    cuts = np.array(bounds, np.int64)

    def number(batch):
        node = np.searchsorted(cuts, batch.column("rank").to_numpy(), side="right").astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(node), batch.column("fp")], names=["node", "fp"])

    numbered = distinct.mapInArrow(lambda batches: map(number, batches), "node int, fp long")
    found = numbered.groupBy("node").agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("any")).collect()
    ones, any_ = np.zeros(len(cuts) + 1, np.int64), np.zeros(len(cuts) + 1, np.int64)
    for row in found:
        ones[row["node"]], any_[row["node"]] = row["ones"], row["any"]
    mask = ~(ones ^ any_)
    return cuts, mask.view(np.uint64), (ones & mask).view(np.uint64)


def near_links(distinct: DataFrame, most: int = MOST_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """a, b: links between distinct fingerprints that connect every pair within `most` bits. distinct: fp, rank."""
    n = distinct.count()
    cuts, masks, patterns = _nodes(distinct, n, node_rows)

    def routed(batch):
        """(node, row) of all nodes that a batch's fingerprints go to, and each row's own node."""
        fp = batch.column("fp").to_numpy().view(np.uint64)
        home = np.searchsorted(cuts, batch.column("rank").to_numpy(), side="right")
        near = np.bitwise_count((fp[:, None] ^ patterns) & masks) <= most
        near &= np.arange(len(masks)) >= home[:, None]
        who, node = np.nonzero(near)
        return node, who, fp, home

    def count(batches):
        visits = np.zeros(len(masks), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                node, who, _, home = routed(batch.slice(at, 4096))
                visits += np.bincount(node[home[who] != node], minlength=len(masks))
        found = np.flatnonzero(visits)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(visits[found])], names=["node", "n"])

    # A row a node: MOST_NODES at most.
    visits = distinct.mapInArrow(count, "node int, n long").groupBy("node").agg(F.sum("n").alias("n")).collect()
    deal = np.ones(len(masks), np.int64)
    for r in visits:
        deal[r["node"]] = -(-r["n"] // TASK_VISITORS)

    def dealt(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                node, who, fp, home = routed(batch.slice(at, 4096))
                resident = home[who] == node
                times = np.where(resident, deal[node], 1)
                row = np.repeat(np.arange(len(node)), times)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                own = fp[who[row]]
                mixed = ((own * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)
                share = np.where(resident[row], nth, mixed % deal[node[row]])
                columns = [node[row].astype(np.int32), share.astype(np.int32), own.view(np.int64), resident[row]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "share", "fp", "resident"])

    def link(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        fp, resident = found.column("fp").to_numpy(), found.column("resident").to_numpy()
        own = fp[resident]
        # Residents among themselves belong to one share; a fingerprint finds itself as well, which joins nothing.
        queries = fp if key[1].as_py() == 0 else fp[~resident]
        a, b = spanning_links(queries, own, most) if len(own) and len(queries) else (fp[:0], fp[:0])
        return pa.table({"a": a, "b": b})

    placed = distinct.mapInArrow(dealt, "node int, share int, fp long, resident boolean")
    return placed.groupBy("node", "share").applyInArrow(link, "a long, b long")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root: each linked fingerprint with the smallest one of its component (alternating star contraction).

    A round hangs each node's larger neighbours, then its smaller ones, under its smallest neighbour. Minima are joined back
    instead of collecting neighbours, so a hub needs no large group. Each round is a table in the shared folder.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = staged(small, "small-star")
        moved = after.join(edges, ["u", "v"], "left_anti").limit(1).count() or edges.join(after, ["u", "v"], "left_anti").limit(1).count()
        edges = after
        if not moved:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"components still moved after {most_rounds} rounds")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """doc_id, fp, component_id (its smallest doc_id) of every row."""
    marked = staged(fingerprints(docs, shingle), "fingerprints")
    first = F.min(F.coalesce("doc_id", F.lit(NO_ID)))
    distinct = staged(marked.groupBy("fp").agg(first.alias("first")).withColumn("rank", _gray_column("fp")), "distinct")
    roots = components(near_links(distinct.select("fp", "rank"), most, node_rows))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = placed.groupBy("root").agg(F.min("first").alias("component"))
    named = placed.join(smallest, "root").select("fp", "component")
    joined = marked.join(named, "fp")
    component = F.when(F.col("component") != NO_ID, F.col("component"))
    return joined.select("doc_id", "fp", component.alias("component_id"))


def hex_fingerprint(fp: str = "fp") -> F.Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
