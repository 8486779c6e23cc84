"""Approximate nearest neighbours: a forest of random-projection trees.

* Trees are fitted on a bounded sample of distinct vectors (``sample``): a node
  projects on the line between two random sample points and splits at the
  median, down to ``leaf`` sample rows. Every row of the table is then routed
  to one leaf of each tree, so the index holds all rows.
* Largest inner product is made nearest direction by one more coordinate,
  ``sqrt(M^2 - |x|^2)`` with M the largest norm, which is 0 for queries.
* A query searches all trees through one priority queue: the queue holds nodes
  by their least margin on the way, and the search ends when ``share`` of all
  leaves have been taken.
* Candidates of the leaves are scored as blocks of vectors against blocks of
  queries; each block gives its best ones only, and the best of all are scored
  again in double precision on the original vectors.

Equal vectors are one entry that knows its 21 smallest ids (no more can be
among 20 neighbours), and equal queries are searched once, so a vector that a
third of the table repeats costs no more than any other. Leaves are cut into
blocks by hash: no task gathers a whole leaf.

Vectors that are null, zero, of another length than most, or with null or
non-finite components take no part; so do rows with a null id. Repeated ids
are rows of their own. Fewer candidates give fewer rows; an empty table none.
Other columns are ignored.

The number of leaves in a tree follows the sample, so at a fixed ``share`` the
rows scored per query grow with the table; a larger ``sample`` deepens the
trees. Measured recall is in the README.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged

TREES = 8
SAMPLE = 20_000
LEAF = 256
SHARE = 0.15
BLOCK = 512
SLACK = 4  # entries kept beyond the neighbours asked for, before exact scores


class Forest:
    """Trees as heap-ordered arrays: node n has the children 2n + 1 and 2n + 2."""

    def __init__(self, points: np.ndarray, trees: int, leaf: int, largest: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.largest = largest
        points = self.raised(points)
        self.depth = max(0, int(np.ceil(np.log2(max(len(points), 1) / leaf))))
        self.inner, self.leaves = (1 << self.depth) - 1, 1 << self.depth
        self.lines = np.zeros((trees, self.inner, points.shape[1]))
        self.cuts = np.zeros((trees, self.inner))
        for t in range(trees):
            at = np.zeros(len(points), dtype=np.int64)
            for node in range(self.inner):
                own = np.flatnonzero(at == node)
                line = rng.normal(size=points.shape[1])
                if len(own) > 1:
                    a, b = points[rng.choice(own, 2, replace=False)]
                    line = a - b if (a != b).any() else line
                self.lines[t, node] = line / np.linalg.norm(line)
                along = points[own] @ self.lines[t, node]
                self.cuts[t, node] = np.median(along) if len(own) else 0.0
                at[own] = 2 * node + 1 + (along > self.cuts[t, node])

    def raised(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.largest**2 - (x * x).sum(1), 0.0))
        return np.concatenate([x, rest[:, None]], 1)

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree, numbered over all trees."""
        x, out = self.raised(x), []
        for t in range(len(self.lines)):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + ((x * self.lines[t, at]).sum(1) > self.cuts[t, at])
            out.append(at - self.inner + t * self.leaves)
        return np.stack(out, 1)

    def search(self, queries: np.ndarray, share: float) -> list[list[int]]:
        """For each query the leaves taken from one queue over all trees."""
        trees = len(self.lines)
        wanted = max(trees, int(np.ceil(share * trees * self.leaves)))
        q = np.concatenate([queries, np.zeros((len(queries), 1))], 1)
        margins = np.einsum("qd,tnd->qtn", q, self.lines, optimize=True) - self.cuts if self.inner else None
        found = []
        for i in range(len(q)):
            own = margins[i].tolist() if self.inner else []
            queue, taken = [(-np.inf, t, 0) for t in range(trees)], []
            while queue and len(taken) < wanted:
                far, t, node = heapq.heappop(queue)  # smallest distance beyond a cut first
                while node < self.inner:
                    margin = own[t][node]
                    near = 2 * node + 1 + (margin > 0)
                    heapq.heappush(queue, (max(far, abs(margin)), t, 4 * node + 3 - near))
                    node = near
                taken.append(node - self.inner + t * self.leaves)
            found.append(taken)
        return found


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return _reshaped(column.flatten(), dim)


def _reshaped(values: pa.Array, dim: int) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _placed(forest, dim: int, blocks: int):
    """One row per vector and tree: its leaf and block."""

    def run(batches):
        for batch in batches:
            leaves = forest.value.leaves_of(_matrix(batch.column("vec"), dim))
            n, trees = leaves.shape
            names = np.repeat(batch.column("name").to_numpy(), trees)
            rows = np.repeat(np.arange(n), trees)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves.ravel()), pa.array((names * 0x9E3779B1 >> 7) % blocks), pa.array(names), batch.column("vec").take(pa.array(rows))],
                names=["leaf", "block", "name", "vec"],
            )

    return run


def _asked(forest, dim: int, share: float):
    """One row per query and leaf to be looked at."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = forest.value.search(_matrix(part.column("vec"), dim), share)
                sizes = [len(x) for x in found]
                rows = np.repeat(np.arange(len(found)), sizes)
                names = np.repeat(part.column("name").to_numpy(), sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([y for x in found for y in x], pa.int64()), pa.array((names * 0x9E3779B1 >> 7) % 64), pa.array(names), part.column("vec").take(pa.array(rows))],
                    names=["leaf", "block", "name", "vec"],
                )

    return run


def _best(dim: int, most: int):
    """The best entries of a block of vectors for each of a block of queries."""

    def run(batches):
        for batch in batches:
            out = []
            columns = [batch.column(c) for c in ("q_names", "q_vecs", "names", "vecs")]
            for i in range(batch.num_rows):
                q_names, q_vecs, names, vecs = (c[i].values for c in columns)
                names, q_names = names.to_numpy(), q_names.to_numpy()
                scores = _reshaped(q_vecs, dim) @ _reshaped(vecs, dim).T
                k = min(most, len(names))
                top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                out.append((np.repeat(q_names, k), names[top].ravel(), np.take_along_axis(scores, top, 1).ravel()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["query", "name", "near"])

    return run


def _valid(vec: Column, dim: int) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (F.size(vec) == dim) & ~bad & F.exists(vec, lambda x: x != 0)


def nearest(
    table: DataFrame,
    query_ids: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 20,
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    share: float = SHARE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products found for the rows that ``query_ids`` marks."""
    spark: SparkSession = table.sparkSession
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), query_ids.alias("asked"), F.col(vec_col).alias("vec"))
    rows = rows.where("vec_id is not null and vec is not null")
    lengths = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    result = "query_id long, rank int, vec_id long, score double"
    if lengths is None or not lengths["dim"]:
        return spark.createDataFrame([], result)
    dim = lengths["dim"]
    rows = rows.where(_valid(F.col("vec"), dim))

    # Entries: distinct vectors with their k + 1 smallest ids.
    least = rows.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    entries = least.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    entries = staged(spark, entries.select(F.col("members")[0].alias("name"), "members", "vec"), "ann-entries")
    asked = rows.where("asked").select(F.col("vec_id").alias("query_id"), "vec")
    queries = staged(spark, asked.join(entries.select("vec", "name"), "vec").select("query_id", "name"), "ann-queries")

    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    n, largest = entries.agg(F.count("*"), F.max(norm)).first()
    if not n:
        return spark.createDataFrame([], result)
    drawn = entries.where(F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30)))
    points = np.array([r["vec"] for r in drawn.select("vec").collect()], dtype=np.float64).reshape(-1, dim)
    forest = spark.sparkContext.broadcast(Forest(points, trees, leaf, float(largest)))

    kind = f"leaf long, block long, name long, vec {entries.schema['vec'].dataType.simpleString()}"
    blocks = max(1, -(-n // (forest.value.leaves * BLOCK)))
    placed = entries.select("name", "vec").mapInArrow(_placed(forest, dim, blocks), kind)
    packed = placed.groupBy("leaf", "block").agg(F.collect_list("name").alias("names"), F.flatten(F.collect_list("vec")).alias("vecs"))
    texts = queries.select("name").distinct().join(entries.select("name", "vec"), "name")
    taken = texts.mapInArrow(_asked(forest, dim, share), kind)
    taken = taken.groupBy("leaf", "block").agg(F.collect_list("name").alias("q_names"), F.flatten(F.collect_list("vec")).alias("q_vecs"))
    pairs = packed.drop("block").join(taken.drop("block"), "leaf")
    pairs = pairs.select("q_names", "q_vecs", "names", "vecs").mapInArrow(_best(dim, k + 1 + SLACK), "query long, name long, near double")

    # Exact scores of the best entries, in order of the components.
    best = pairs.groupBy("query", "name").agg(F.max("near").alias("near"))
    best = best.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("near"), "name")))
    best = best.where(F.col("r") <= k + 1 + SLACK).select("query", "name")
    right = entries.select("name", "members", F.col("vec").alias("b"))
    left = entries.select(F.col("name").alias("query"), F.col("vec").alias("a"))
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    scored = best.join(right, "name").join(left, "query").select("query", "members", product.alias("score"))
    ranked = queries.join(scored, F.col("name") == F.col("query")).select("query_id", "score", F.explode("members").alias("vec_id"))
    ranked = ranked.where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
