"""Registered queries: one per operator of the inventory, each (spark, sf_dir) -> DataFrame.

Inputs come from the driver's tables through :mod:`reelstar.sources.fixtures`,
so every query's work grows with the scale factor. Output timestamps are cast
to TIMESTAMP_NTZ (UTC wall clock) and structs are flattened so results
compare column by column with the SQL oracle (:mod:`reelstar.plans.oracle`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas
from reelstar.functions import columns as fn
from reelstar.operators import landing as ld
from reelstar.operators import profile as pf
from reelstar.operators import quality as dq
from reelstar.operators.latest import dedup, first_n_per_key, latest_per_key
from reelstar.plans import analytics as an
from reelstar.plans import pipeline
from reelstar.plans import star as st
from reelstar.session import checkpoint_dir
from reelstar.sources import fixtures as fx
from reelstar.sources.event_source import DatedSource
from reelstar.sources.json_layout import CORRUPT, parsed, records_of_text, split_corrupt
from reelstar.sources.raw import events_media_from_path, stats_media_id, with_path_media, with_run

Query = Callable[[SparkSession, str], DataFrame]

LOOKBACK_SECONDS = 3600
SAMPLE_PER_MEDIA = 5
LANDING_RUN_ID, LANDING_RUN_DATE = "20240201T060000Z", "2024-02-01"
LANDING_STARTED, LANDING_FINISHED = "2024-02-01T06:00:00+00:00", "2024-02-01T06:04:30+00:00"


def _flat_events(df: DataFrame) -> DataFrame:
    """Raw event columns with the user-agent struct flattened."""
    cols = [c for c in df.columns if c != "user_agent_details" and not c.startswith("__")]
    return df.select(
        *cols,
        F.col("user_agent_details.browser").alias("browser"),
        F.col("user_agent_details.platform").alias("platform"),
        F.col("user_agent_details.mobile").alias("mobile"),
    )


def _star(spark: SparkSession, sf: str) -> st.Star:
    return st.build_star(fx.raw_events(spark, sf), fx.raw_metadata(spark, sf), fx.raw_stats(spark, sf), fx.channel_rules())


def _staged_star(spark: SparkSession, sf: str) -> tuple[st.Star, dict[str, int]]:
    """For reports on several tables: the events are scanned and deduplicated once."""
    return pipeline.staged_star(spark, fx.raw_events(spark, sf), fx.raw_metadata(spark, sf), fx.raw_stats(spark, sf), fx.channel_rules())


def _ntz_dim_media(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", fn.to_ntz("created_at")).withColumn("updated_at", fn.to_ntz("updated_at"))


def _dated(spark: SparkSession, sf: str) -> DatedSource:
    """The event source stored by day in the shared folder, as a deployment keeps it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/reelstar-source/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    return DatedSource.write(fx.source_events(spark, sf), path)


def _landing(spark: SparkSession, sf: str, lookback: int = 0, dated: bool = False) -> ld.LandingPlan:
    return ld.plan_landing(
        _dated(spark, sf) if dated else fx.source_events(spark, sf),
        fx.landing_state(spark, sf),
        fx.configured_media(spark, sf),
        run_id=LANDING_RUN_ID,
        run_date=LANDING_RUN_DATE,
        lookback_seconds=lookback,
    )


# ---- scans / provenance ------------------------------------------------------


def _records(files: DataFrame, schema) -> DataFrame:
    """Records of landed file texts, by the same reading as files: layout from the text, malformed ones marked."""
    return parsed(files.select(F.inline(records_of_text(F.col("text"))), "_source_file"), schema)


def _scans(spark, sf) -> dict[str, DataFrame]:
    return {
        "events": with_path_media(_records(fx.event_files(spark, sf), schemas.RAW_EVENT)),
        "media_metadata": _records(fx.metadata_files(spark, sf), schemas.RAW_METADATA),
        "media_stats": _records(fx.stats_files(spark, sf), schemas.RAW_STATS),
    }


def q_scan_events(spark, sf):
    return _flat_events(with_run(split_corrupt(_scans(spark, sf)["events"])[0]))


def q_scan_metadata(spark, sf):
    return with_run(split_corrupt(_scans(spark, sf)["media_metadata"])[0])


def q_scan_stats(spark, sf):
    df = split_corrupt(_scans(spark, sf)["media_stats"])[0]
    return with_run(df).withColumn("media_id", stats_media_id("_source_file"))


def q_scan_quarantine(spark, sf):
    """Records and malformed records of every run and kind."""
    out = None
    for kind, found in _scans(spark, sf).items():
        one = with_run(found).groupBy("run_id").agg(
            F.count(F.lit(1)).alias("records"), F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed")
        )
        one = one.select(F.lit(kind).alias("kind"), "run_id", "records", "malformed")
        out = one if out is None else out.unionByName(one)
    return out


def q_source_files(spark, sf):
    """Rows by the table that their file belongs to, from the reader's own file path."""
    out = None
    for name in ("events", "part", "pages"):
        path = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.parquet)(/[^/]*)?$", 1).alias("source_table")
        one = fx.table(spark, sf, name).select(path)
        out = one if out is None else out.unionByName(one)
    return out.groupBy("source_table").agg(F.count(F.lit(1)).alias("rows"))


def q_path_provenance(spark, sf):
    ev = fx.raw_events(spark, sf).select(
        F.lit("events").alias("kind"), "_source_file", events_media_from_path("_source_file").alias("media_id")
    )
    stt = fx.raw_stats(spark, sf).select(
        F.lit("media_stats").alias("kind"), "_source_file", fn.stats_media_from_path("_source_file").alias("media_id")
    )
    return with_run(ev.unionByName(stt))


def q_sample_events(spark, sf):
    ev = fx.source_events(spark, sf).withColumn("__ts", fn.parse_ts("received_at"))
    order = [F.col("__ts").asc_nulls_last(), F.col("event_key").asc_nulls_last()]
    return first_n_per_key(ev, ["media_id"], order, SAMPLE_PER_MEDIA).select("media_id", "event_key", "received_at")


# ---- dedup / latest ------------------------------------------------------------


def q_dedup_events(spark, sf):
    ev = st.dedup_events(fx.raw_events(spark, sf))
    return _flat_events(ev).drop("_source_file")


def q_dedup_lineitem(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    order = [
        F.col("l_shipdate").desc_nulls_last(),
        F.col("l_extendedprice").desc_nulls_last(),
        F.col("l_partkey").desc_nulls_last(),
        F.col("l_suppkey").desc_nulls_last(),
        F.col("l_quantity").desc_nulls_last(),
        F.col("l_discount").desc_nulls_last(),
        F.col("l_tax").desc_nulls_last(),
        F.col("l_returnflag").desc_nulls_last(),
        F.col("l_linestatus").desc_nulls_last(),
    ]
    return dedup(li, ["l_orderkey", "l_linenumber"], order)


def q_latest_metadata(spark, sf):
    return st.latest_metadata(fx.raw_metadata(spark, sf)).drop("_source_file", "run_date")


def q_latest_stats(spark, sf):
    return st.latest_stats(fx.raw_stats(spark, sf)).select("media_id", "play_rate", "run_id")


def q_latest_media_url(spark, sf):
    return st.latest_media_url(st.dedup_events(fx.raw_events(spark, sf)))


def q_latest_visitor(spark, sf):
    lv = st.latest_visitor(st.dedup_events(fx.raw_events(spark, sf)))
    return _flat_events(lv).drop("_source_file", "run_date")


def q_latest_order_per_customer(spark, sf):
    orders = fx.table(spark, sf, "orders")
    order = [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc_nulls_last()]
    return latest_per_key(orders, ["o_custkey"], order)


# ---- star schema -------------------------------------------------------------------


def q_dim_media(spark, sf):
    return _ntz_dim_media(_star(spark, sf).dim_media)


def q_dim_visitor(spark, sf):
    return _star(spark, sf).dim_visitor


def q_fact_engagement(spark, sf):
    return _star(spark, sf).fact.withColumn("received_at", fn.to_ntz("received_at"))


def q_stage_counts(spark, sf):
    """Rows of every stage: the first two observed while the dedup is staged, the tables counted from it."""
    s, seen = _staged_star(spark, sf)
    out = spark.createDataFrame(list(seen.items()), "stage string, row_count long")
    for name, df in (("dim_media", s.dim_media), ("dim_visitor", s.dim_visitor), ("fact_media_engagement", s.fact)):
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), "row_count"))
    return out


# ---- scalar functions ----------------------------------------------------------------


def q_channel(spark, sf):
    pages = fx.table(spark, sf, "pages").select("page_id", "url")
    return pages.select("page_id", "url", fn.channel_of("url", fx.channel_rules()).alias("channel"))


def q_visitor_hash(spark, sf):
    ev = fx.source_events(spark, sf)
    return ev.select("event_key", "visitor_key", fn.visitor_hash("visitor_key").alias("visitor_id"))


def q_parse_timestamps(spark, sf):
    ev = fx.source_events(spark, sf)
    ts = fn.parse_ts("received_at")
    return ev.select(
        "event_key",
        "received_at",
        fn.to_ntz(ts).alias("received_ts"),
        fn.event_date(ts).alias("received_date"),
        fn.is_rejected_ts("received_at").alias("rejected"),
    )


def q_nested_fields(spark, sf):
    ev = fx.source_events(spark, sf)
    return ev.select(
        "event_key",
        F.col("user_agent_details.browser").alias("browser"),
        F.col("user_agent_details.platform").alias("platform"),
        F.col("user_agent_details.mobile").alias("mobile"),
    )


def q_run_ids(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", "ts")
    return ev.select("event_id", fn.run_id_of("ts").alias("run_id"), fn.run_date_of("ts").alias("run_date"))


def q_json_roundtrip(spark, sf):
    ev = fx.source_events(spark, sf)
    enc = ev.select(F.to_json(F.struct(*[F.col(c) for c in ev.columns])).alias("json"))
    dec = enc.select(F.from_json("json", schemas.RAW_EVENT).alias("r")).select("r.*")
    return _flat_events(dec)


# ---- landing -------------------------------------------------------------------------


def q_media_allow_list(spark, sf):
    catalog = st.latest_metadata(fx.raw_metadata(spark, sf)).where(F.col("status") == "ready")
    return ld.restrict_to_media(fx.source_events(spark, sf), catalog).select("event_key", "media_id", "received_at")


def q_incremental_events(spark, sf):
    return _landing(spark, sf).saved.select("event_key", "media_id", "received_at")


def q_incremental_pruned(spark, sf):
    return _landing(spark, sf, dated=True).fetched.select("event_key", "media_id", "received_at")


def q_incremental_lookback(spark, sf):
    return _landing(spark, sf, LOOKBACK_SECONDS).saved.select("event_key", "media_id", "received_at")


def q_checkpoint_advance(spark, sf):
    return _landing(spark, sf).new_state


def q_run_manifest(spark, sf):
    manifest = _landing(spark, sf).manifest
    header = ld.run_header(manifest, run_id=LANDING_RUN_ID, run_date=LANDING_RUN_DATE, started_at=LANDING_STARTED, finished_at=LANDING_FINISHED)
    media = manifest.withColumn("record", F.lit("media"))
    return media.unionByName(header.withColumn("record", F.lit("run")), allowMissingColumns=True)


# ---- analytics -------------------------------------------------------------------------


def q_sql_row_counts(spark, sf):
    s, _ = _staged_star(spark, sf)
    return an.row_counts(s.dim_media, s.dim_visitor, s.fact)


def q_sql_counts_one_row(spark, sf):
    s, _ = _staged_star(spark, sf)
    return an.counts_one_row(s.dim_media, s.dim_visitor, s.fact)


def q_sql_by_media(spark, sf):
    return an.by_media(_star(spark, sf).fact)


def q_sql_by_title(spark, sf):
    s = _star(spark, sf)
    return an.by_title(s.fact, s.dim_media)


def q_sql_watch_minutes(spark, sf):
    s = _star(spark, sf)
    return an.watch_minutes(s.fact, s.dim_media)


def q_sql_uniqueness(spark, sf):
    return an.uniqueness(_star(spark, sf).fact)


def q_sql_visitors_by_country(spark, sf):
    return an.visitors_by_country(_star(spark, sf).dim_visitor)


# ---- data quality ------------------------------------------------------------------------


def q_dq_duplicates(spark, sf):
    return dq.duplicates_report(fx.raw_events(spark, sf), "event_key")


def q_dq_percent_range(spark, sf):
    return dq.range_report(fx.raw_events(spark, sf), "percent_viewed", 0.0, 1.0)


def q_dq_orphans(spark, sf):
    s, _ = _staged_star(spark, sf)
    return dq.orphans(s.fact, s.dim_media, s.dim_visitor)


def q_dq_report(spark, sf):
    s, _ = _staged_star(spark, sf)
    return dq.quality_report(s.fact, s.dim_media, s.dim_visitor)


# ---- profiling ------------------------------------------------------------------------------


def q_profile_fields(spark, sf):
    return pf.field_profile(spark, fx.profile_records(spark, sf), totals=True)


def q_profile_nested(spark, sf):
    return pf.nested_profile(spark, fx.nested_records(spark, sf))


def q_profile_snapshots(spark, sf):
    """Q1/Q2 for the metadata and stats payloads (all records of both runs)."""
    meta = pf.records_as_json(fx.raw_metadata(spark, sf).drop("_source_file"))
    stats = pf.records_as_json(fx.raw_stats(spark, sf).drop("_source_file"))
    return pf.field_profile(spark, meta).withColumn("source", F.lit("media_metadata")).unionByName(
        pf.field_profile(spark, stats).withColumn("source", F.lit("media_stats"))
    )


def q_visitor_last_event(spark, sf):
    ev = st.dedup_events(fx.raw_events(spark, sf))
    visitors = st.latest_visitor(ev).select("visitor_key", F.col("event_key").alias("last_event_key"))
    return pf.visitor_last_event(visitors, ev)


QUERIES: dict[str, Query] = {
    "scan_events": q_scan_events,
    "scan_metadata": q_scan_metadata,
    "scan_stats": q_scan_stats,
    "scan_quarantine": q_scan_quarantine,
    "source_files": q_source_files,
    "path_provenance": q_path_provenance,
    "sample_events": q_sample_events,
    "dedup_events": q_dedup_events,
    "dedup_lineitem": q_dedup_lineitem,
    "latest_metadata": q_latest_metadata,
    "latest_stats": q_latest_stats,
    "latest_media_url": q_latest_media_url,
    "latest_visitor": q_latest_visitor,
    "latest_order_per_customer": q_latest_order_per_customer,
    "dim_media": q_dim_media,
    "dim_visitor": q_dim_visitor,
    "fact_engagement": q_fact_engagement,
    "stage_counts": q_stage_counts,
    "channel": q_channel,
    "visitor_hash": q_visitor_hash,
    "parse_timestamps": q_parse_timestamps,
    "nested_fields": q_nested_fields,
    "run_ids": q_run_ids,
    "json_roundtrip": q_json_roundtrip,
    "media_allow_list": q_media_allow_list,
    "incremental_events": q_incremental_events,
    "incremental_pruned": q_incremental_pruned,
    "incremental_lookback": q_incremental_lookback,
    "checkpoint_advance": q_checkpoint_advance,
    "run_manifest": q_run_manifest,
    "sql_row_counts": q_sql_row_counts,
    "sql_counts_one_row": q_sql_counts_one_row,
    "sql_by_media": q_sql_by_media,
    "sql_by_title": q_sql_by_title,
    "sql_watch_minutes": q_sql_watch_minutes,
    "sql_uniqueness": q_sql_uniqueness,
    "sql_visitors_by_country": q_sql_visitors_by_country,
    "dq_duplicates": q_dq_duplicates,
    "dq_percent_range": q_dq_percent_range,
    "dq_orphans": q_dq_orphans,
    "dq_report": q_dq_report,
    "profile_fields": q_profile_fields,
    "profile_nested": q_profile_nested,
    "profile_snapshots": q_profile_snapshots,
    "visitor_last_event": q_visitor_last_event,
}
