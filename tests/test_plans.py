"""Physical-plan properties the design relies on."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from reelstar.plans import star as st
from reelstar.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top1_runs_partially_before_the_shuffle(spark):
    text = plan_text(st.dedup_events(fx.raw_events(spark, SF)))
    # AQE wraps the plan; the initial plan lists both group-limit phases.
    initial = spark._jvm.org.apache.spark.sql.execution.adaptive.AdaptiveSparkPlanExec
    assert initial is not None
    formatted = st.dedup_events(fx.raw_events(spark, SF))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert formatted.count("WindowGroupLimit") >= 2
    assert "Exchange" in text or "Exchange" in formatted


@pytest.mark.parametrize("name", sorted(entry._registry.QUERIES))
def test_no_python_and_no_cross_join_in_query_plans(spark, name):
    df = entry.queries()[name](spark, SF)
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert not any(node in formatted for node in PYTHON_NODES), name
    # no cross joins / all-pairs work anywhere
    assert "CartesianProduct" not in formatted and "BroadcastNestedLoopJoin" not in formatted, name


def test_page_lookup_reads_all_pages_and_two_columns(spark):
    formatted = fx.source_events(spark, SF)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert not re.search(r"(Less|Greater)Than(OrEqual)?\(page_id", formatted)  # every page is reachable
    assert "ReadSchema: struct<page_id:bigint,url:string>" in formatted  # html never read


def test_fact_joins_do_not_fan_out(spark):
    s = st.build_star(fx.raw_events(spark, SF), fx.raw_metadata(spark, SF), fx.raw_stats(spark, SF))
    assert s.fact.count() == s.events.count() == s.fact.select("engagement_id").distinct().count()
    assert s.dim_media.count() == s.dim_media.select("media_id").distinct().count()
    assert s.dim_visitor.count() == s.dim_visitor.select("visitor_id").distinct().count()


def test_small_dimension_lookups_are_broadcast(spark):
    s = st.build_star(fx.raw_events(spark, SF), fx.raw_metadata(spark, SF), fx.raw_stats(spark, SF))
    fact = s.fact
    fact.collect()  # executes this DataFrame's plan: AQE's final plan is inspected
    text = fact._jdf.queryExecution().executedPlan().toString()
    # the one per-media lookup (duration, play rate) joins by broadcast, not by shuffling the events
    assert re.search(r"BroadcastHashJoin \[media_id#\d+\], \[\S+\], LeftOuter", text)


GOLDEN = {
    # FIXTURES.md section 5, computed independently with DuckDB.
    "/root/testdata/sf0.001": {"raw_events": 1175, "unique_events": 1000, "dim_media": 200, "dim_visitor": 15, "fact_media_engagement": 1000},
    "/root/testdata/sf0.01": {"raw_events": 11660, "unique_events": 10000, "dim_media": 2000, "dim_visitor": 150, "fact_media_engagement": 10000},
}


@pytest.mark.parametrize("sf_dir", sorted(GOLDEN))
def test_golden_stage_counts(spark, sf_dir):
    got = {r.stage: r.row_count for r in entry.queries()["stage_counts"](spark, sf_dir).collect()}
    assert got == GOLDEN[sf_dir]


def test_curated_fact_prunes_partitions_and_columns(spark, tmp_path):
    from reelstar.plans import pipeline
    from reelstar.sources import raw

    curated = str(tmp_path / "curated")
    pipeline.run_transform(spark, fx.raw_events(spark, SF), fx.raw_metadata(spark, SF), fx.raw_stats(spark, SF), curated)
    fact = raw.read_curated(spark, curated, "fact_media_engagement")
    q = fact.where(F.col("date") == F.lit("2024-01-10").cast("date")).groupBy("media_id").agg(F.sum("total_watch_time"))
    formatted = q._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert re.search(r"PartitionFilters: \[.*date.*2024-01-10", formatted)  # only that day's directory is listed/read
    assert "ReadSchema: struct<media_id:string,total_watch_time:double>" in formatted  # 2 of 9 columns
    assert q.count() > 0


def test_a_hot_media_is_split_in_the_fact_join(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        media = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), (F.col("id") % 50).cast("string")))
        events = spark.range(0, 60_000, numPartitions=16).select(
            F.sha2(F.col("id").cast("string"), 256).alias("event_key"), media.alias("media_id"), F.sha2(F.col("id").cast("string"), 512).alias("visitor_key"),
            F.lit(0.5).alias("percent_viewed"), F.lit("2024-01-01T00:00:00.000Z").cast("timestamp").alias(st.TS),
        )
        one = spark.range(50).select(F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id").cast("string"))).alias("media_id"))
        fact = st.build_fact(events, one.withColumn("duration", F.lit(10.0)), one.withColumn("play_rate", F.lit(0.5)))
        assert len(fact.collect()) == 60_000
        assert "skew=true" in plan_text(fact)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
