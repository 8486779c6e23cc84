"""Shared pieces of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.session import checkpoint_dir, remove_path

# Ranges of doc_id that one ordered job is cut into; also the bound of what
# the driver ever holds of an ordering (one boundary and one total a range).
MIN_RANGES = 12
MAX_RANGES = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/reelstar-llm/{spark.sparkContext.applicationId}"


def staged(spark: SparkSession, df: DataFrame, tag: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of repeating the
    work. All tables of one application share one folder, so they can be
    dropped together when it ends.
    """
    path = f"{_shared(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.options(**options).format(fmt).save(path)
    return spark.read.schema(df.schema).format(fmt).load(path)


def unstaged(spark: SparkSession, folder: str) -> None:
    """Remove the tables whose tags begin with ``folder`` and a slash."""
    remove_path(spark, f"{_shared(spark)}/{folder}")


@contextmanager
def spent_files_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a step go as soon as its result is written, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Components of an undirected graph by alternating large and small stars.

    ``edges`` has columns ``a`` and ``b`` of one orderable type; loops, repeats
    and rows with nulls are ignored. Returns ``node, root`` for every node that
    has an edge, ``root`` being the smallest node of its component. Each round
    keeps at most one row per edge and needs joins on a node only, so no
    component is ever gathered in one place; each round is checkpointed.
    """
    pairs = (
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .distinct()
    )
    pairs = checkpointed(spark, pairs)
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.select(F.col("u").alias("x"), F.col("v").alias("y")).union(pairs.select("v", "u"))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        pairs = checkpointed(spark, small.union(low).distinct())
        was, mark = mark, _mark(pairs)
        if was == mark:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.union(pairs.select("u", "u").distinct())


def _mark(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u"))).first())


def ranges(df: DataFrame, key: str, weight: str, bytes_per_range: int) -> list[int]:
    """Boundaries that cut ``key`` (a long) into ranges of about equal weight.

    Their number follows the data (total weight over ``bytes_per_range``), at
    least the session's shuffle partitions and at most ``MAX_RANGES``.
    """
    spark = df.sparkSession
    total = df.agg(F.sum(weight)).first()[0] or 0
    n = max(MIN_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // bytes_per_range))
    n = min(n, MAX_RANGES)
    found = df.where(F.col(key).isNotNull()).approxQuantile(key, [i / n for i in range(1, n)], 0.2 / n)
    return sorted({int(x) for x in found})


def range_of(key: Column, bounds: list[int]) -> Column:
    """Index of the range that ``key`` falls in; a null key is in the first."""
    return F.coalesce(_search(key, bounds, 0, len(bounds)), F.lit(0))


def _search(k: Column, bounds: list[int], low: int, high: int) -> Column:
    # A binary search as nested conditions: log2(ranges) comparisons a row.
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(k < F.lit(bounds[mid]), _search(k, bounds, low, mid)).when(
        k >= F.lit(bounds[mid]), _search(k, bounds, mid + 1, high)
    )
