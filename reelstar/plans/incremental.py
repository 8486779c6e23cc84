"""Incremental transform: keep deduplicated events in a date-partitioned
store and merge each run's new events into it, instead of re-reading and
re-deduplicating all history every run.

Per run (``new_raw_events`` = only the newly landed runs):

1. affected dates = dates of the new events ∪ dates of stored copies of the
   same event keys, looked up in a key index bucketed by key
   (:mod:`reelstar.sinks.key_index`), so the stored keys are not shuffled;
2. merged = dedup(stored rows of the affected dates ∪ new events). That is
   the same total order as the full transform, so a redelivered copy that
   wins moves its row, and one that loses changes nothing;
3. the merged rows are staged in the shared checkpoint folder and written
   back with **dynamic partition overwrite**, which replaces only the
   affected ``date=`` directories. An affected date left with no rows is
   removed explicitly;
4. dimensions and fact are rebuilt from the store. That is a narrow scan plus
   per-media lookups and the top-1 windows, with no dedup shuffle over
   history. The fact stamps the *latest* stats/duration on every event, so
   it is rewritten whole each run.

The result equals a full rebuild over all runs
(``tests/test_incremental.py``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from reelstar import schemas
from reelstar.functions import columns as fn
from reelstar.plans import star as st
from reelstar.plans.pipeline import write_star
from reelstar.session import checkpoint_dir, remove_path
from reelstar.sinks import curated as cur
from reelstar.sinks.key_index import DAY, KEY, KeyIndex, key_of

DATE = "date"
STORE_SCHEMA = StructType(
    list(schemas.RAW_EVENT.fields)
    + [
        StructField("_source_file", StringType(), True),
        StructField("run_id", StringType(), True),
        StructField("run_date", StringType(), True),
        StructField(st.TS, TimestampType(), True),
        StructField(DATE, DateType(), True),
    ]
)
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def read_store(spark: SparkSession, store_path: str) -> DataFrame | None:
    try:
        return spark.read.schema(STORE_SCHEMA).parquet(store_path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return None
        raise


def _with_date(events: DataFrame) -> DataFrame:
    return events.withColumn(DATE, fn.event_date(st.TS))


def _delete_partitions(spark: SparkSession, store_path: str, dates: list) -> None:
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for d in dates:
        value = NULL_PARTITION if d is None else d.isoformat()
        path = jvm.org.apache.hadoop.fs.Path(f"{store_path.rstrip('/')}/{DATE}={value}")
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            fs.delete(path, True)


def _in_dates(dates: list) -> F.Column:
    """Partition filter on ``date`` (static pruning; a null date is its own partition)."""
    known = [d for d in dates if d is not None]
    cond = F.col(DATE).isin(known) if known else F.lit(False)
    return cond | F.col(DATE).isNull() if None in dates else cond


def merge_new_events(spark: SparkSession, new_raw_events: DataFrame, store_path: str) -> dict[str, int]:
    """Merge newly landed raw events into the deduplicated event store."""
    stage = f"{checkpoint_dir(spark).rstrip('/')}/reelstar-merge-{uuid.uuid4().hex}"
    try:
        return _merge(spark, new_raw_events, store_path, stage)
    finally:
        remove_path(spark, stage)


def _merge(spark: SparkSession, new_raw_events: DataFrame, store_path: str, stage: str) -> dict[str, int]:
    cols = [f.name for f in STORE_SCHEMA.fields]
    # The new events are used three times (keys, dates, merge): parse them once.
    _with_date(st.prepare_events(new_raw_events)).select(*cols).write.parquet(f"{stage}/new")
    new = spark.read.schema(STORE_SCHEMA).parquet(f"{stage}/new")

    existing = read_store(spark, store_path)
    index = KeyIndex(spark, f"{store_path.rstrip('/')}_keys")
    if existing is not None and not index.exists():  # a store from before there was an index
        index.add(existing.select(key_of("event_key").alias(KEY), F.col(DATE).alias(DAY)))
    affected: list | None = None
    keys = new.select(key_of("event_key").alias(KEY), F.col(DATE).alias(DAY))
    if existing is None:
        merged = _with_date(st.dedup_events(new.drop(DATE)))
    else:
        # One row per calendar day touched: a small list, used as a static
        # partition filter so only those days of the store are read.
        days = keys.select(DAY).union(index.known(keys).select(DAY)).distinct()
        affected = [r[DAY] for r in days.collect()]
        old = existing.where(_in_dates(affected))
        # Same columns (same order) as the full transform's dedup, so even the
        # last-resort row-hash tiebreak picks the same survivor.
        merged = _with_date(st.dedup_events(old.unionByName(new).drop(DATE)))
    index.add(keys)  # before the events: see the index
    merged.select(*cols).write.parquet(f"{stage}/merged")
    staged = spark.read.schema(STORE_SCHEMA).parquet(f"{stage}/merged")

    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        cur.write_table(staged, store_path, partition_by=(DATE,), mode="overwrite")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)

    emptied: list = []
    if affected:
        # Days whose every row moved to another day get no new files under
        # dynamic overwrite: remove them explicitly.
        kept = {r[DATE] for r in staged.select(DATE).distinct().collect()}
        emptied = [d for d in affected if d not in kept]
        _delete_partitions(spark, store_path, emptied)
    return {"affected_dates": len(affected or []), "emptied_dates": len(emptied)}


def run_incremental_transform(
    spark: SparkSession,
    new_raw_events: DataFrame,
    raw_metadata: DataFrame,
    raw_stats: DataFrame,
    curated_root: str,
    *,
    store_path: str | None = None,
    channel_rules: Sequence[tuple[str, str]] = fn.DEFAULT_CHANNEL_RULES,
    db: str | None = None,
) -> dict[str, int]:
    """Merge new events into the store, then rebuild the curated tables from it."""
    store = store_path or cur.table_path(curated_root, "events_dedup")
    merge_new_events(spark, new_raw_events, store)
    events = read_store(spark, store).drop(DATE)
    star = st.build_star(None, raw_metadata, raw_stats, channel_rules, events=events)
    return write_star(spark, star, curated_root, db=db)
