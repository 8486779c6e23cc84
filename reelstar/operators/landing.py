"""Incremental landing against a per-media high-water mark.

The ingestion job fetched events media by media and page by page and kept
only those newer than a persisted per-media mark. Here the whole run is one
DataFrame plan over a source frame of events for all media at once:

    source  ⋈ (configured media ⟕ state)            (P13 allow-list, J5 mark lookup)
            σ ts >= day(mark)                       (P12 coarse fetch, "start_date":
                                                     a partition filter on a dated source)
            σ received_at non-blank ∧ ts > mark     (P10, P11 strict; optional lookback)

plus one aggregation per media for the manifest counters and the new mark
(partial aggregation on the map side, so a media holding a third of all
events costs one partial row per task, not a hot reducer).

Semantics kept from the reference:

* strictly-greater comparison: an event at exactly the mark is not landed
  (opt-in ``lookback`` re-lands a window; downstream dedup makes that safe);
* blank ``received_at`` is fetched but never saved;
* the new mark is the latest instant over all *fetched* events and the old
  mark, keeping the original string; ties keep the old mark;
* media with no new events keep their mark; marks of media not configured
  in this run are carried over unchanged;
* mode is ``incremental`` when a mark existed, else ``full``.

Changed on purpose: a non-blank timestamp that does not parse is rejected
and counted (``events_rejected``) instead of aborting the run; a stored mark
that does not parse is treated as absent (full reload of that media, then a
good mark replaces it) instead of aborting.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas
from reelstar.functions import columns as fn
from reelstar.sources.event_source import DatedSource

MARK = "__mark"
TS = "__ts"
MARK_TS = "__mark_ts"
SAVED = "__saved"
KNOWN = "__known"


def restrict_to_media(events: DataFrame, media: DataFrame | list[str]) -> DataFrame:
    """Keep only configured media (literal list or a frame of ids)."""
    if isinstance(media, list):
        return events.where(F.col("media_id").isin(media))
    return events.join(media.select("media_id").distinct(), "media_id", "left_semi")


def run_header(manifest: DataFrame, *, run_id: str, run_date: str, started_at: str, finished_at: str, status: str = "success", error: str | None = None) -> DataFrame:
    """K5: the run as one record: start, finish, status and the totals of its media rows.

    The run's media are its media rows, one each, so the header does not grow with them.
    """
    totals = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("pages_fetched", "events_fetched", "events_saved", "events_rejected")]
    one = manifest.agg(F.count(F.lit(1)).alias("media_count"), *totals)
    fixed = {"run_id": run_id, "run_date": run_date, "started_at_utc": started_at, "finished_at_utc": finished_at, "status": status, "error": error}
    given = {c: F.lit(v).cast("string").alias(c) for c, v in fixed.items()}
    return one.select(*[given.get(c, F.col(c)) for c in schemas.RUN_HEADER.names])


@dataclass
class LandingPlan:
    fetched: DataFrame  # events the source returns under the coarse date filter
    saved: DataFrame  # events to land
    manifest: DataFrame  # one row per configured media (schemas.MANIFEST)
    new_state: DataFrame  # checkpoint after the run (schemas.STATE)


def universe_of(source: DataFrame | DatedSource, media: DataFrame | list[str] | None) -> DataFrame:
    """One row a media of the run; a null media is a media."""
    if isinstance(media, list):
        return source_session(source).createDataFrame([(m,) for m in media], "media_id string").distinct()
    if media is None:
        media = source.read() if isinstance(source, DatedSource) else source
    return media.select("media_id").distinct()


def source_session(source: DataFrame | DatedSource) -> SparkSession:
    return source.spark if isinstance(source, DatedSource) else source.sparkSession


def carried_marks(state: DataFrame, media: DataFrame) -> DataFrame:
    """Marks of the media that are not among ``media`` (null-safe: a null media is one)."""
    run = media.select(F.col("media_id").alias(KNOWN)).distinct()
    return state.select("media_id", "last_received_at").join(run, F.col("media_id").eqNullSafe(F.col(KNOWN)), "left_anti")


def plan_landing(
    source_events: DataFrame | DatedSource,
    state: DataFrame,
    media: DataFrame | list[str] | None = None,
    *,
    run_id: str,
    run_date: str,
    lookback_seconds: int = 0,
    page_size: int = fn.EVENT_PAGE_SIZE,
) -> LandingPlan:
    payload_cols = source_events.columns
    # One small frame of media with their marks, so that the events meet one
    # join: it is allow-list and mark lookup at once.
    universe = universe_of(source_events, media)
    marks = state.select(F.col("media_id").alias("__of"), F.col("last_received_at").alias(MARK))
    known = universe.withColumnRenamed("media_id", KNOWN)
    known = known.join(marks, F.col(KNOWN).eqNullSafe(F.col("__of")), "left").drop("__of").withColumn(MARK_TS, fn.parse_ts(MARK))

    # A mark that does not parse counts as no mark: the media reloads in full
    # (dedup removes the copies) instead of never landing again.
    has_mark = F.col(MARK_TS).isNotNull()
    cutoff = F.col(MARK_TS)
    fetch_from = fn.mark_day_start(MARK)
    if lookback_seconds:
        cutoff = cutoff - F.make_interval(secs=F.lit(lookback_seconds))
        # a lookback reaching into an earlier day must fetch from that day
        fetch_from = F.least(fetch_from, fn.day_start(cutoff))
    if isinstance(source_events, DatedSource):
        ev = source_events.fetch(known, F.col(KNOWN), F.when(has_mark, fetch_from))
    else:
        ev = source_events.join(known, F.col("media_id").eqNullSafe(F.col(KNOWN)))
    ev = ev.drop(KNOWN).withColumn(TS, fn.parse_ts("received_at"))
    # The source filters by calendar day only; records without a usable time
    # cannot be filtered by it and come back.
    fetched = ev.where(~has_mark | F.col(TS).isNull() | (F.col(TS) >= fetch_from))
    saved_flag = ~fn.is_blank("received_at") & F.col(TS).isNotNull() & (~has_mark | (F.col(TS) > cutoff))
    fetched = fetched.withColumn(SAVED, saved_flag)
    saved = fetched.where(F.col(SAVED)).select(*payload_cols)

    timed = F.col(TS).isNotNull()
    per_media = fetched.groupBy("media_id").agg(
        F.count(F.lit(1)).alias("events_fetched"),
        F.count_if(F.col(SAVED)).alias("events_saved"),
        F.count_if(fn.is_rejected_ts("received_at")).alias("events_rejected"),
        F.max_by(F.when(timed, F.col("received_at")), F.when(timed, F.struct(F.col(TS), F.col("received_at")))).alias(
            "__newest"
        ),
    )

    per_media = per_media.withColumnRenamed("media_id", "__of")
    m = known.join(per_media, F.col(KNOWN).eqNullSafe(F.col("__of")), "left").withColumnRenamed(KNOWN, "media_id")
    fetched_n = F.coalesce(F.col("events_fetched"), F.lit(0)).cast("long")
    manifest = m.select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_date).alias("run_date"),
        F.col("media_id"),
        F.when(fn.parse_ts(MARK).isNotNull(), F.lit("incremental")).otherwise(F.lit("full")).alias("mode"),
        F.col(MARK).alias("checkpoint_before"),
        fn.newer_mark(MARK, "__newest").alias("checkpoint_after"),
        fn.pages_for(fetched_n, page_size).alias("pages_fetched"),
        fetched_n.alias("events_fetched"),
        F.coalesce(F.col("events_saved"), F.lit(0)).cast("long").alias("events_saved"),
        F.coalesce(F.col("events_rejected"), F.lit(0)).cast("long").alias("events_rejected"),
        F.lit("success").alias("status"),
        F.lit(None).cast("string").alias("error"),
    )

    advanced = manifest.where(F.col("checkpoint_after").isNotNull()).select(
        "media_id", F.col("checkpoint_after").alias("last_received_at")
    )
    new_state = advanced.unionByName(carried_marks(state, universe))
    return LandingPlan(fetched.drop(SAVED), saved, manifest, new_state)
