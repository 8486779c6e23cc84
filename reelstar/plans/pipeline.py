"""End-to-end jobs: transform (M4) and landing run (M5).

``run_transform`` reads raw history **once**: the deduplicated events are
written as a staged Parquet table in the shared checkpoint folder (the
cluster's ``spark.checkpoint.dir``), which also cuts the lineage so a lost
executor re-reads staged Parquet rather than re-parsing raw JSON. The three
outputs then read that stage; stage counts are collected with
``DataFrame.observe`` during the writes, not by extra jobs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas
from reelstar.functions import columns as fn
from reelstar.operators.landing import carried_marks, plan_landing, run_header, universe_of
from reelstar.plans import star as st
from reelstar.session import checkpoint_dir, remove_path
from reelstar.sinks import curated as cur
from reelstar.sinks import landing as land
from reelstar.sources.event_source import DatedSource


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def run_transform(
    spark: SparkSession,
    raw_events: DataFrame,
    raw_metadata: DataFrame,
    raw_stats: DataFrame,
    curated_root: str,
    *,
    channel_rules: Sequence[tuple[str, str]] = fn.DEFAULT_CHANNEL_RULES,
    stage_root: str | None = None,
    db: str | None = None,
) -> dict[str, int]:
    """Build and write ``dim_media``, ``dim_visitor``, ``fact_media_engagement``.

    The staged events are removed at the end, also of a failed run, unless the
    caller named ``stage_root``.
    """
    stage = stage_root or f"{checkpoint_dir(spark).rstrip('/')}/reelstar-stage-{uuid.uuid4().hex}"
    try:
        return _transform(spark, raw_events, raw_metadata, raw_stats, curated_root, channel_rules, stage, db)
    finally:
        if stage_root is None:
            remove_path(spark, stage)


def stage_events(spark: SparkSession, raw_events: DataFrame, stage: str) -> tuple[DataFrame, dict[str, int]]:
    """Deduplicated events, written once, and the rows before and after as observed while writing."""
    raw_obs_df, raw_obs = _counted(raw_events, "raw_events")
    deduped, uniq_obs = _counted(st.dedup_events(raw_obs_df), "unique_events")
    deduped.write.mode("overwrite").parquet(f"{stage}/events")
    events = spark.read.schema(deduped.schema).parquet(f"{stage}/events")
    return events, {"raw_events": raw_obs.get["rows"], "unique_events": uniq_obs.get["rows"]}


def staged_star(
    spark: SparkSession,
    raw_events: DataFrame,
    raw_metadata: DataFrame,
    raw_stats: DataFrame,
    channel_rules: Sequence[tuple[str, str]] = fn.DEFAULT_CHANNEL_RULES,
) -> tuple[st.Star, dict[str, int]]:
    """The star over events staged once, for reports that read several of its tables.

    The stage lies in the application's folder of the shared checkpoint
    directory, as the returned frames are read later.
    """
    stage = f"{checkpoint_dir(spark).rstrip('/')}/reelstar-star/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    events, counts = stage_events(spark, raw_events, stage)
    return st.build_star(None, raw_metadata, raw_stats, channel_rules, events=events), counts


def _transform(spark, raw_events, raw_metadata, raw_stats, curated_root, channel_rules, stage, db) -> dict[str, int]:
    events, seen = stage_events(spark, raw_events, stage)
    star = st.build_star(None, raw_metadata, raw_stats, channel_rules, events=events)
    return {**seen, **write_star(spark, star, curated_root, db=db)}


def write_star(spark: SparkSession, star: st.Star, curated_root: str, *, db: str | None = None) -> dict[str, int]:
    """K6 (+K7/K8): write the three curated tables, counting rows during the writes."""
    outputs = {
        "dim_media": (star.dim_media, ()),
        "dim_visitor": (star.dim_visitor, ()),
        "fact_media_engagement": (star.fact, cur.FACT_PARTITIONS),
    }
    observations = {}
    for name, (df, parts) in outputs.items():
        counted, obs = _counted(df, name)
        cur.write_table(counted, cur.table_path(curated_root, name), partition_by=parts)
        observations[name] = obs
    if db:
        cur.register_tables(spark, db, curated_root)
    return {name: obs.get["rows"] for name, obs in observations.items()}


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def run_landing(
    spark: SparkSession,
    source_events: DataFrame | DatedSource,
    media: DataFrame | list[str] | None,
    state_root: str,
    raw_root: str,
    *,
    run_id: str,
    run_date: str,
    metadata: DataFrame | None = None,
    stats: DataFrame | None = None,
    lookback_seconds: int = 0,
) -> DataFrame:
    """One landing run: data, then manifest, then the new checkpoint version.

    A :class:`DatedSource` is read from the first open day on. Returns the
    manifest as written (read back from the run directory).
    """
    store = land.StateStore(spark, state_root)
    stage = f"{checkpoint_dir(spark).rstrip('/')}/reelstar-landing-{uuid.uuid4().hex}"
    run = {"run_id": run_id, "run_date": run_date}
    started = _now()
    try:
        # The source is read once: saved events, counters and marks all come
        # from the same staged rows, so no mark can pass an event that a second
        # reading of a growing source would have brought.
        state = store.read()
        first = plan_landing(source_events, state, media, lookback_seconds=lookback_seconds, **run)
        first.fetched.select(*source_events.columns).write.parquet(stage)
        fetched = spark.read.schema(source_events.schema).parquet(stage)
        universe = universe_of(source_events, media) if media is None else media
        plan = plan_landing(fetched, state, universe, lookback_seconds=lookback_seconds, **run)
        if metadata is not None:
            land.land_metadata(metadata, raw_root, run_id, run_date)
        if stats is not None:
            land.land_stats(stats, raw_root, run_id, run_date)
        land.land_events(plan.saved, raw_root, run_id, run_date)
        land.land_manifest(plan.manifest, raw_root, run_id, run_date)
        written = spark.read.schema(schemas.MANIFEST).json(f"{land.run_prefix(raw_root, run_id, run_date)}/run_manifest.json")
        land.land_header(run_header(written, started_at=started, finished_at=_now(), **run), raw_root, run_id, run_date)
    except Exception as exc:
        # Failed run: record it (status + error per configured media) and keep
        # the previous checkpoint, so the next run re-lands what this one lost.
        _write_failed_manifest(source_events, media, raw_root, run, started, exc)
        raise
    finally:
        remove_path(spark, stage)

    manifest = spark.read.schema(schemas.MANIFEST).json(f"{land.run_prefix(raw_root, run_id, run_date)}/run_manifest.json")
    # New marks from the *written* manifest: no recomputation of the run.
    advanced = manifest.where(F.col("checkpoint_after").isNotNull()).select(
        "media_id", F.col("checkpoint_after").alias("last_received_at")
    )
    store.write(advanced.unionByName(carried_marks(state, manifest)), run_id)
    return manifest


def _write_failed_manifest(source_events, media, raw_root, run, started, exc) -> None:
    error = f"{type(exc).__name__}: {exc}"
    try:
        failed = universe_of(source_events, media).select(
            F.lit(run["run_id"]).alias("run_id"),
            F.lit(run["run_date"]).alias("run_date"),
            "media_id",
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.MANIFEST.fields[3:-2]],
            F.lit("failed").alias("status"),
            F.lit(error).alias("error"),
        )
        header = run_header(failed, started_at=started, finished_at=_now(), status="failed", error=error, **run)
        land.land_manifest(failed, raw_root, run["run_id"], run["run_date"])
        land.land_header(header, raw_root, run["run_id"], run["run_date"])
    except Exception:  # noqa: BLE001 - the original error is the one to raise
        pass
