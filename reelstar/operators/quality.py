"""Data-quality checks.

Every check is one aggregation pass producing a small
report frame; :func:`assert_quality` is the only place a row reaches the
driver, and it is a single report row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicates_report(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, duplicate rows and missing keys."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNull()).alias("missing_keys"),
    ).select(
        "rows",
        "distinct_keys",
        (F.col("rows") - F.col("distinct_keys") - F.col("missing_keys")).alias("duplicate_rows"),
        "missing_keys",
    )


def range_report(df: DataFrame, column: str, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Observed range of a measure and rows outside ``[lo, hi]``."""
    c = F.col(column)
    return df.agg(
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
        F.count_if(c.isNotNull() & ~c.between(lo, hi)).alias("out_of_range"),
        F.count_if(c.isNull()).alias("null_values"),
    )


MEDIA, VISITOR, ENGAGEMENT = "fact_media_engagement.media_id", "fact_media_engagement.visitor_id", "fact_media_engagement.engagement_id"


def _key_uses(fact: DataFrame, dim_media: DataFrame, dim_visitor: DataFrame, *more: Column) -> DataFrame:
    """One row for every (relation, key): ``uses`` in the fact and whether a dimension ``defines`` it.

    One pass over the fact names all keys of each row, null foreign keys aside;
    the dimensions' keys are added with no use, and one aggregation with
    map-side partials brings both sides together, so a hot key sends one row a
    task and no side is joined.
    """

    def use(relation: str, key: str, defined: bool = False) -> Column:
        return F.struct(F.lit(relation).alias("relation"), F.col(key).alias("key"), F.lit(0 if defined else 1).alias("use"), F.lit(defined).alias("defined"), *more_null)

    more_null = [F.lit(0).alias(f"more_{i}") for i in range(len(more))]
    own = F.struct(F.lit(ENGAGEMENT).alias("relation"), F.col("engagement_id").alias("key"), F.lit(1).alias("use"), F.lit(False).alias("defined"), *[m.alias(f"more_{i}") for i, m in enumerate(more)])
    uses = [use(MEDIA, "media_id"), use(VISITOR, "visitor_id"), *([own] if more else [])]
    kept = F.filter(F.array(*uses), lambda x: x["key"].isNotNull() | (x["relation"] == ENGAGEMENT))
    found = fact.select(F.inline(kept))
    for dim, relation, key in ((dim_media, MEDIA, "media_id"), (dim_visitor, VISITOR, "visitor_id")):
        found = found.unionByName(dim.where(F.col(key).isNotNull()).select(F.inline(F.array(use(relation, key, True)))))
    sums = [F.sum(f"more_{i}").alias(f"more_{i}") for i in range(len(more))]
    return found.groupBy("relation", "key").agg(F.sum("use").alias("uses"), F.max("defined").alias("defines"), *sums)


def _orphan_rows(relation: str) -> Column:
    return F.coalesce(F.sum(F.when((F.col("relation") == relation) & ~F.col("defines"), F.col("uses"))), F.lit(0)).cast("long")


def orphans(fact: DataFrame, dim_media: DataFrame, dim_visitor: DataFrame) -> DataFrame:
    """Fact rows whose non-null foreign key has no dimension row."""
    one = _key_uses(fact, dim_media, dim_visitor).agg(_orphan_rows(MEDIA).alias("media"), _orphan_rows(VISITOR).alias("visitor"))
    rows = [F.struct(F.lit(r).alias("relation"), F.col(c).alias("orphan_rows")) for r, c in ((MEDIA, "media"), (VISITOR, "visitor"))]
    return one.select(F.inline(F.array(*rows)))


def quality_report(fact: DataFrame, dim_media: DataFrame, dim_visitor: DataFrame) -> DataFrame:
    """Q5: the gates in one row, from **one** pass over the fact.

    Uniqueness of the fact key and presence of the foreign keys are read off
    one aggregation by key; ``passed`` is true when the fact key is unique and
    present, the percent lies in 0-100, and no foreign key dangles.
    """
    wp = F.col("watched_percent")
    outside = F.when(wp.isNotNull() & ~wp.between(0.0, 100.0), 1).otherwise(0)
    own = F.col("relation") == ENGAGEMENT
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    rep = _key_uses(fact, dim_media, dim_visitor, outside).agg(
        total(F.when(own, F.col("uses"))).alias("fact_rows"),
        F.count_if(own & F.col("key").isNotNull()).alias("distinct_engagement_ids"),
        total(F.when(own & F.col("key").isNull(), F.col("uses"))).alias("missing_engagement_ids"),
        total("more_0").alias("watched_percent_out_of_range"),
        _orphan_rows(MEDIA).alias("orphan_media_rows"),
        _orphan_rows(VISITOR).alias("orphan_visitor_rows"),
    )
    rep = rep.select(
        "fact_rows",
        "distinct_engagement_ids",
        (F.col("fact_rows") - F.col("distinct_engagement_ids") - F.col("missing_engagement_ids")).alias(
            "duplicate_engagement_ids"
        ),
        "missing_engagement_ids",
        "watched_percent_out_of_range",
        "orphan_media_rows",
        "orphan_visitor_rows",
    )
    return rep.withColumn(
        "passed",
        (F.col("duplicate_engagement_ids") == 0)
        & (F.col("missing_engagement_ids") == 0)
        & (F.col("watched_percent_out_of_range") == 0)
        & (F.col("orphan_media_rows") == 0)
        & (F.col("orphan_visitor_rows") == 0),
    )


class QualityError(AssertionError):
    pass


def assert_quality(report: DataFrame) -> dict:
    """Fail the run when the one-row report did not pass."""
    row = report.first().asDict()
    if not row.get("passed"):
        raise QualityError(f"data-quality gates failed: {row}")
    return row
