"""N-gram Jaccard join: size-aware heavy-light set join and its link groups.

A document's set holds the distinct word n-grams of its whole text. Two
documents link when ``100 * |A & B| >= percent * |A | B|``; the result gives
each document the smallest doc_id it can reach over links.

* Equal sets are one *node*; only nodes are joined.
* **Light** sets (at most ``boundary`` n-grams) list all their subsets of the
  sizes a partner could need: sizes a and b link exactly when they share a
  subset of ``overlap(a, b)`` n-grams, so a shared (a, b, subset) key is a link
  and needs no check.
* **Heavy** sets are found through inverted lists. A list holds the sets that
  have the n-gram among their ``n - ceil(percent/100 * n) + 1`` first ones in a
  common order; linked sets always meet in one. N-grams of frequent hash
  buckets come last in the order, so passages that many documents share
  hardly ever make a list. Any order is right; the counts only make it fast.
* The **boundary** is the one of least cost over the sizes found: rows that
  subsets would make, against rows and checks of the lists.
* N-grams of one set only make no list. A list of at most ``FEW`` rows emits
  its pairs, and those that share enough lists are checked: n-grams in common
  that are in no shared list lie behind the listed ones of one of the sets, so
  linked sets share at least ``overlap(a, b) - ceil(percent/100 * larger) + 1``
  lists. The larger lists that a set is in count as shared here.
* A larger list never emits all its pairs. Its members are checked against a
  pivot; after that only pairs that are still in different groups are checked,
  first by further pivots, then all that are left. So links inside one group
  are not repeated, yet no link between groups is lost.
* Each set has a **parity sketch**: for 1,024 buckets of the hash space one bit,
  whether an odd number of its n-grams falls there. Sketches never differ in
  more bits than the sets do in n-grams, so pairs of sketches that differ in
  more than ``a + b - 2 * overlap(a, b)`` bits do not link. The pairs left
  of a list are sifted by it inside their join, all others before their sets
  are made. A set of more than 512 n-grams has a second sketch of two to four
  bits for each of them, so that also large sets seldom travel in vain.

Null or empty texts, and texts without words, have the empty set: size 0,
linked with nothing, group of their own. Repeated rows of a doc_id count as
equal copies when their texts agree. Rows with a null doc_id take no part.
Other columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .coded import slices
from .common import connected_components, staged
from .links import grouped_links
from .shingles import shingle_sets

BUCKETS = 1 << 20  # counters of the common order: 4 MB on each executor
BLOCK = 1 << 14  # counters of a partition in one row
WORDS = 16  # longs of a set's parity sketch
FEW = 8  # rows of a list whose pairs are all looked at at once
LARGEST_LIGHT = 24  # no boundary above this is considered
MOST_SENT = 2_000_000  # nodes (32 MB) that are broadcast to find their texts; more are joined by a shuffle
SIZES = "doc_id long, n long, node long, parity array<long>, fine binary, block long, counts binary"
ROW_COST, CHECK_COST = 1.0, 4.0  # a key row; a list row with its checks


def overlap(a: int, b: int, percent: int) -> int:
    """Least common n-grams of linked sets of a and b n-grams."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def partner_sizes(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subsets_made(n: int, most: int, percent: int) -> int:
    return sum(comb(n, overlap(n, m, percent)) for m in partner_sizes(n, percent) if m <= most)


def choose_boundary(histogram: dict[int, int], percent: int) -> int:
    """The largest light size that makes the join cheapest. ``histogram``: sets by size up to 2 * LARGEST_LIGHT."""

    def cost(most: int) -> float:
        light = sum(k * subsets_made(n, most, percent) for n, k in histogram.items() if 0 < n <= most)
        listed = sum(k * prefix_length(n, percent) for n, k in histogram.items() if n >= least_listed(most, percent))
        return ROW_COST * light + CHECK_COST * listed

    return min(range(LARGEST_LIGHT + 1), key=lambda most: (cost(most), most))


def least_listed(boundary: int, percent: int) -> int:
    """Smallest size that can link with a heavy set."""
    return -(-percent * (boundary + 1) // 100)


def _sets_of(batches, width: int, name: str = "doc_id"):
    """Per slice of the batches, pairs of a row's name and its set."""
    for part in (part for whole in batches for part in slices(whole)):
        yield zip(part.column(name).to_pylist(), shingle_sets(part.column("text"), width))


def _sizes(width: int):
    """Per document its set's size and identity; at the end the bucket counts of the partition, packed by blocks."""

    def run(batches):
        counts = np.zeros(BUCKETS, dtype=np.uint32)
        for found in _sets_of(batches, width):
            ids, sizes, nodes, parities, fine, met = [], [], [], [], [], [np.zeros(0, dtype=np.int64)]
            for doc_id, own in found:
                ids.append(doc_id)
                sizes.append(len(own))
                nodes.append(_node(own))
                parities.append(_parity(own))
                fine.append(_fine(own))
                met.append((own % np.uint64(BUCKETS)).astype(np.int64))
            np.add.at(counts, np.concatenate(met), 1)
            yield _rows(ids, sizes, nodes, parities, fine, [None] * len(ids), [None] * len(ids))
        blocks = [i for i in range(BUCKETS // BLOCK) if counts[i * BLOCK : (i + 1) * BLOCK].any()]
        packed = [zlib.compress(counts[i * BLOCK : (i + 1) * BLOCK].tobytes(), 1) for i in blocks]
        none = [None] * len(blocks)
        yield _rows(none, none, none, none, none, blocks, packed)

    return run


def _node(own: np.ndarray) -> int:
    """Identity of a set: a 63-bit hash of its sorted n-grams."""
    return xxhash.xxh3_64_intdigest(own.tobytes()) >> 1


def _parity(own: np.ndarray, bits: int = 64 * WORDS) -> np.ndarray:
    """For each of ``bits`` buckets whether it holds an odd number of n-grams.

    Sketches differ in no more bits than n-grams are in just one of the two sets.
    """
    met = np.bincount((own >> np.uint64(32)).astype(np.int64) % bits, minlength=bits)
    return np.packbits(met.astype(np.uint8) & 1).view(np.int64)


def _fine(own: np.ndarray) -> bytes | None:
    """A sketch of two to four bits for each n-gram of a set that is too large for the common one."""
    return _parity(own, 1 << (2 * len(own) - 1).bit_length()).tobytes() if 2 * len(own) > 64 * WORDS else None


def _rows(ids, sizes, nodes, parities, fine, blocks, packed) -> pa.RecordBatch:
    long, binary = pa.int64(), pa.binary()
    types = [long, long, long, pa.list_(long), binary, long, binary]
    columns = [pa.array(x, t) for x, t in zip((ids, sizes, nodes, parities, fine, blocks, packed), types)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "node", "parity", "fine", "block", "counts"])


def _entries(width: int, percent: int, boundary: int, order):
    """List and subset entries of each set that the partition has not met before."""
    listed = least_listed(boundary, percent)

    def run(batches):
        frequent = order.value
        met: set[int] = set()
        for found in _sets_of(batches, width):
            keys, nodes, sizes, others = [], [], [], []
            for doc_id, own in found:
                n, node = len(own), _node(own)
                if n == 0 or doc_id is None or node in met:
                    continue
                met.add(node)
                if n >= listed:
                    common = frequent[(own % np.uint64(BUCKETS)).astype(np.int64)]
                    first = np.lexsort((own, common))[: prefix_length(n, percent)]
                    keys.append(own[first].astype(np.int64))
                    nodes.append(np.full(len(first), node))
                    sizes.append(np.full(len(first), n))
                    others.append(np.zeros(len(first), dtype=np.int64))
                if n <= boundary:
                    for m in partner_sizes(n, percent):
                        if m > boundary:
                            continue
                        made = np.array(
                            [_subset_key(min(n, m), max(n, m), s) for s in combinations(own.tolist(), overlap(n, m, percent))],
                            dtype=np.int64,
                        )
                        keys.append(made)
                        nodes.append(np.full(len(made), node))
                        sizes.append(np.full(len(made), n))
                        others.append(np.full(len(made), m))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(t)) for x, t in zip((keys, nodes, sizes, others), (np.int64, np.int64, np.int32, np.int32))],
                    names=["key", "node", "n", "m"],
                )

    return run


def _subset_key(a: int, b: int, subset: tuple[int, ...]) -> int:
    h = a * 1_000_003 + b
    for x in subset:
        h = (h ^ x) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
        h ^= h >> 29
    return h >> 1


def _sets(width: int):
    def run(batches):
        for found in _sets_of(batches, width, "node"):
            # rows that share a doc_id may have other texts: their sets are other nodes
            same = [(node, own.tobytes()) for node, own in found if node == _node(own)]
            nodes, sets = zip(*same) if same else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "grams"])

    return run


def _near(percent: int):
    """Of pairs with the finer sketches of two large sets, those that may link; the larger sketch is folded to the other's length."""

    def run(batches):
        for batch in batches:
            keep = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("x_n", "y_n", "x_fine", "y_fine"))):
                if x is None or y is None:
                    keep.append(True)
                    continue
                bits = min(len(x), len(y)) // 8
                x, y = (np.bitwise_xor.reduce(np.frombuffer(s, dtype=np.uint64).reshape(-1, bits)) for s in (x, y))
                keep.append(int(np.bitwise_count(x ^ y).sum()) <= a + b - 2 * overlap(a, b, percent))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _linked(percent: int):
    """Of pairs with both sets, those that link."""

    def run(batches):
        for batch in batches:
            a_s, b_s, keep = batch.column("a_grams").to_pylist(), batch.column("b_grams").to_pylist(), []
            for a, b in zip(a_s, b_s):
                a, b = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
                at = np.searchsorted(a, b)
                at[at == len(a)] = 0
                common = int((a[at] == b).sum())
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield kept.select(["a", "b"])

    return run


def jaccard_groups(docs: DataFrame, width: int = 4, percent: int = 85, boundary: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    found = staged(
        spark, docs.mapInArrow(_sizes(width), SIZES), "jaccard-sizes"
    )
    sets = found.where("block is null")
    if boundary is None:
        small = sets.where(f"n between 1 and {2 * LARGEST_LIGHT}").groupBy("n").count().collect()
        boundary = choose_boundary({r["n"]: r["count"] for r in small}, percent)
    order = spark.sparkContext.broadcast(_common_order(found))
    entries = staged(
        spark,
        docs.mapInArrow(_entries(width, percent, boundary, order), "key long, node long, n int, m int"),
        "jaccard-entries",
    )
    edges = _light_edges(entries).union(_heavy_edges(spark, docs, sets, entries, width, percent, boundary))
    groups = connected_components(spark, edges)
    reps = sets.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"))
    rooted = reps.join(groups, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(least, "root").select("node", "component_id")
    return sets.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def _summed(batches):
    """The blocks of a partition added up, one row for each."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            own = sums.setdefault(block, np.zeros(BLOCK, dtype=np.int64))
            own += np.frombuffer(zlib.decompress(counts), dtype=np.uint32)
    for block, own in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([own.tobytes()], pa.binary())], names=["block", "counts"])


def _common_order(found: DataFrame) -> np.ndarray:
    """Count of each bucket that stands out, else 0: BUCKETS numbers, whatever the input."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    blocks = found.where("block is not null").select("block", "counts").repartition("block")
    for r in blocks.mapInArrow(_summed, "block long, counts binary").toLocalIterator():
        counts[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], dtype=np.int64)
    mean, spread = counts.mean(), counts.std()
    # Poisson noise of an even spread; the measured spread also holds the frequent ones
    limit = mean + 4 * min(spread, mean**0.5) + 4
    return np.where(counts > limit, np.minimum(counts, np.iinfo(np.int32).max), 0).astype(np.int32)


def _light_edges(entries: DataFrame) -> DataFrame:
    """A star for each subset key that joins its two sizes."""
    light = entries.where("m > 0")
    keyed = light.groupBy("key").agg(
        F.min(F.struct("n", "node")).alias("low"), F.max(F.struct("n", "node")).alias("top"), F.max("m").alias("m")
    )
    # Sizes a < b: every set of size a links with every one of size b. Equal sizes: all link.
    live = keyed.where("low.node <> top.node and (top.n > low.n or low.n = m)").drop("m")
    links = light.select("key", "node", "n").join(live, "key")
    up = links.where("(n > low.n or top.n = low.n) and node <> low.node").select(F.col("low.node").alias("a"), F.col("node").alias("b"))
    down = links.where("n = low.n and top.n > low.n").select(F.col("top.node").alias("a"), F.col("node").alias("b"))
    return up.union(down).distinct()


def _heavy_edges(
    spark: SparkSession, docs: DataFrame, sets: DataFrame, entries: DataFrame, width: int, percent: int, boundary: int
) -> DataFrame:
    lists = entries.where("m = 0").select("key", "node", "n")
    ends = lists.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y"), F.count("*").alias("size")).where("x <> y")
    keys = staged(spark, ends.select("key", F.expr(f"size > {FEW}").alias("many")), "jaccard-keys")
    # Most n-grams are in one set only, and their entries end here. ``many_lists``: how many of a node's lists are left to the pivots.
    shared = lists.join(keys, "key").repartition("node").dropDuplicates(["node", "key"])
    shared = shared.withColumn("many_lists", F.count_if("many").over(Window.partitionBy("node")).cast("int"))
    lists = staged(spark, shared, "jaccard-lists")
    first = F.min("doc_id").alias("doc_id"), F.any_value("n").alias("n"), F.any_value("parity").alias("parity"), F.any_value("fine").alias("fine")
    nodes = staged(spark, sets.where("n > 0").groupBy("node").agg(*first), "jaccard-nodes")

    larger = "greatest(x_n, y_n)"
    fits = f"100 * least(x_n, y_n) >= {percent} * {larger} and {larger} > {boundary}"
    needed = f"(({percent} * (x_n + y_n) + {99 + percent}) div {100 + percent})"
    least_shared = f"{needed} - ({percent} * {larger} + 99) div 100 + 1"
    differ = " + ".join(f"bit_count(x_parity[{i}] ^ y_parity[{i}])" for i in range(WORDS))
    close = f"{differ} <= x_n + y_n - 2 * {needed}"

    def checked(pairs: DataFrame) -> DataFrame:
        """Pairs that link; the sets of pairs with close sketches are made from one document each."""
        pairs = staged(spark, pairs, "jaccard-pairs")
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        known = staged(spark, nodes.join(ends, "node", "left_semi"), "jaccard-ends")
        x = known.select(F.col("node").alias("a"), *[F.col(c).alias(f"x_{c}") for c in ("n", "parity", "fine")])
        y = known.select(F.col("node").alias("b"), *[F.col(c).alias(f"y_{c}") for c in ("n", "parity", "fine")])
        near = pairs.join(x, "a").join(y, "b").where(close).select("a", "b", "x_n", "y_n", "x_fine", "y_fine")
        pairs = staged(spark, near.mapInArrow(_near(percent), "a long, b long"), "jaccard-close")
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        reps = staged(spark, known.join(ends, "node", "left_semi").select("node", "doc_id"), "jaccard-reps")
        side = F.broadcast(reps) if reps.count() <= MOST_SENT else reps
        grams = staged(spark, docs.join(side, "doc_id").mapInArrow(_sets(width), "node long, grams binary"), "jaccard-sets")
        a_s = grams.select(F.col("node").alias("a"), F.col("grams").alias("a_grams"))
        b_s = grams.select(F.col("node").alias("b"), F.col("grams").alias("b_grams"))
        return pairs.join(a_s, "a").join(b_s, "b").mapInArrow(_linked(percent), "a long, b long")

    few = lists.where("not many")
    x = few.select("key", F.col("node").alias("a"), F.col("n").alias("x_n"), F.col("many_lists").alias("x_many"))
    y = few.select("key", F.col("node").alias("b"), F.col("n").alias("y_n"), F.col("many_lists").alias("y_many"))
    # Linked nodes share least_shared lists; at most the smaller of the two numbers are not among these.
    rest = F.any_value(F.expr(f"{least_shared} - least(x_many, y_many)")).alias("rest")
    pairs = x.join(y, "key").where(f"a < b and ({fits})").groupBy("a", "b").agg(F.count("*").alias("shared"), rest)
    known = checked(pairs.where("shared >= rest").select("a", "b"))
    many = lists.where("many").select("key", "node", "n")
    return grouped_links(spark, many, ["n"], fits, checked, known=known, details=nodes.select("node", "parity"), close=close)
