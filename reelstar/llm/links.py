"""Link groups from candidate lists without making all pairs of a list."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, connected_components

PIVOT_ROUNDS = 4  # before all pairs that are left are checked


def _members(lists: DataFrame, attributes: list[str]) -> DataFrame:
    return lists.select("key", F.struct("node", *attributes).alias("node"))


def _first_pivots(lists: DataFrame, attributes: list[str]) -> DataFrame:
    pivots = lists.groupBy("key").agg(F.min(F.struct(*[f"node.{c}" for c in attributes], "node.node")).alias("p"))
    return pivots.select("key", F.struct("p.node", *[f"p.{c}" for c in attributes]).alias("node"))


def _pairs_of(attributes: list[str], fits: str, close: str, left: DataFrame, right: DataFrame, rule: str, more: list[str] = []) -> DataFrame:
    x = left.select("key", F.col("node.node").alias("a"), *[F.col(f"node.{c}").alias(f"x_{c}") for c in attributes], F.col("root").alias("x_root"), *[F.col(c).alias(f"x_{c}") for c in more])
    y = right.select("key", F.col("node.node").alias("b"), *[F.col(f"node.{c}").alias(f"y_{c}") for c in attributes], F.col("root").alias("y_root"), *[F.col(c).alias(f"y_{c}") for c in more])
    pairs = x.join(y, "key").where(f"{rule} and ({fits})" + (f" and {close}" if more else ""))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _pivot_pairs(lists: DataFrame, pivots: DataFrame, attributes: list[str], fits: str) -> DataFrame:
    alone = F.lit(None).cast("long").alias("root")
    return _pairs_of(attributes, fits, "true", pivots.select("*", alone), lists.select("*", alone), "a <> b")


def pivot_pairs(lists: DataFrame, attributes: list[str], fits: str) -> DataFrame:
    """The pairs ``a, b`` that ``grouped_links`` checks first: those of each list's first pivot."""
    lists = _members(lists, attributes)
    return _pivot_pairs(lists, _first_pivots(lists, attributes), attributes, fits)


def grouped_links(
    spark: SparkSession,
    lists: DataFrame,
    attributes: list[str],
    fits: str,
    checked: Callable[[DataFrame], DataFrame],
    known: DataFrame | None = None,
    details: DataFrame | None = None,
    close: str = "true",
    pivoted: bool = False,
    most: int = 16,
) -> DataFrame:
    """Links ``a, b`` that connect all nodes that checks of pairs sharing a list would connect.

    ``lists``: key, node and the attributes of the node. ``fits``: a cheap
    symmetric condition over x_<attribute> and y_<attribute>. ``checked``:
    keeps the pairs (a, b) that link. ``known``: links that are already sure.
    ``close``: a narrower condition that holds for all links, also over the
    columns of ``details`` (node, further attributes); it sifts the pairs of
    the last step inside their join, so that members of a large list that are
    alike but not linked make no rows. ``pivoted``: ``known`` already connects
    what checks of ``pivot_pairs`` would. ``most``: pairs a member of a list
    that are few enough to be all checked.

    Every list is first checked against one pivot. Later rounds take only the
    lists whose members are still in different groups, and only pairs across
    groups; pivots come from the smallest group of a list. When few pairs are
    left, or after PIVOT_ROUNDS rounds, all of them are checked. Links that
    are not made lie inside one group.
    """
    lists = _members(lists, attributes)
    more = [c for c in details.columns if c != "node"] if details is not None else []
    pairs_of = partial(_pairs_of, attributes, fits, close)
    pivots = _first_pivots(lists, attributes)
    if pivoted:
        links = checkpointed(spark, known.select("a", "b"))
    else:
        found = checked(_pivot_pairs(lists, pivots, attributes, fits))
        links = checkpointed(spark, found if known is None else found.union(known.select("a", "b")))
    done = pivots.select(F.col("key").alias("used_key"), F.col("node.node").alias("used"))
    for turn in range(PIVOT_ROUNDS + 1):
        groups = connected_components(spark, links).select(F.col("node").alias("id"), "root")
        rows = lists.join(groups, F.col("node.node") == F.col("id"), "left").select("key", "node", F.coalesce("root", "node.node").alias("root"))
        shares = rows.groupBy("key", "root").agg(F.count("*").alias("k"))
        sizes = shares.groupBy("key").agg(F.sum("k").alias("size"), F.sum(F.col("k") * F.col("k")).alias("squares"), F.count("*").alias("parts"))
        sizes = checkpointed(spark, sizes.where("parts > 1").withColumn("cross", F.expr("(size * size - squares) div 2")))
        left, listed = sizes.agg(F.sum("cross"), F.sum("size")).first()
        if not left:
            break
        open_ = checkpointed(spark, rows.join(sizes.select("key"), "key"))
        if turn == PIVOT_ROUNDS or left <= most * listed:
            if details is not None:
                open_ = open_.join(details.withColumnRenamed("node", "id"), F.col("node.node") == F.col("id")).drop("id")
            return links.union(checkpointed(spark, checked(pairs_of(open_, open_, "a < b and x_root <> y_root", more))))
        unused = open_.join(done, (F.col("key") == F.col("used_key")) & (F.col("node.node") == F.col("used")), "left_anti")
        ranked = unused.join(shares, ["key", "root"])
        pivots = ranked.groupBy("key").agg(F.min(F.struct("k", F.xxhash64("node.node", F.lit(turn)).alias("h"), "node", "root")).alias("p"))
        pivots = checkpointed(spark, pivots.select("key", "p.node", "p.root"))
        links = checkpointed(spark, links.union(checked(pairs_of(pivots, open_, "x_root <> y_root"))))
        done = checkpointed(spark, done.union(pivots.select("key", F.col("node.node"))))
    return links
