"""Explicit schemas for every raw and curated table.

Raw JSON is never schema-inferred: inference costs one extra pass over the
input per read, silently drops a nested field that no sampled record carries,
and types an all-whole-number ``percent_viewed`` as ``bigint``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(name: str, dtype=StringType(), nullable: bool = True) -> StructField:
    return StructField(name, dtype, nullable)


USER_AGENT = StructType([_s("browser"), _s("platform"), _s("mobile", BooleanType())])

# One element of an events page (landed as a JSON array, one file per page).
RAW_EVENT = StructType(
    [
        _s("event_key"),
        _s("media_id"),
        _s("media_url"),
        _s("visitor_key"),
        _s("received_at"),
        _s("percent_viewed", DoubleType()),
        _s("ip"),
        _s("country"),
        _s("region"),
        _s("city"),
        _s("user_agent_details", USER_AGENT),
    ]
)

# One element of the media-metadata snapshot.
RAW_METADATA = StructType(
    [
        _s("hashed_id"),
        _s("name"),
        _s("created"),
        _s("updated"),
        _s("duration", DoubleType()),
        _s("status"),
    ]
)

# One media-statistics object; the media id lives only in the file name.
RAW_STATS = StructType([_s("play_rate", DoubleType())])

# Landing state: one row per media.
STATE = StructType([_s("media_id"), _s("last_received_at")])

# Run manifest, one row per (run, media).
MANIFEST = StructType(
    [
        _s("run_id"),
        _s("run_date"),
        _s("media_id"),
        _s("mode"),
        _s("checkpoint_before"),
        _s("checkpoint_after"),
        _s("pages_fetched", LongType()),
        _s("events_fetched", LongType()),
        _s("events_saved", LongType()),
        _s("events_rejected", LongType()),
        _s("status"),
        _s("error"),
    ]
)

# Run header, one row per run; the run's media are the rows of its manifest.
RUN_HEADER = StructType(
    [
        _s("run_id"),
        _s("run_date"),
        _s("started_at_utc"),
        _s("finished_at_utc"),
        _s("media_count", LongType()),
        _s("pages_fetched", LongType()),
        _s("events_fetched", LongType()),
        _s("events_saved", LongType()),
        _s("events_rejected", LongType()),
        _s("status"),
        _s("error"),
    ]
)

# Curated star schema.
DIM_MEDIA = StructType(
    [
        _s("media_id"),
        _s("title"),
        _s("url"),
        _s("channel"),
        _s("created_at", TimestampType()),
        _s("updated_at", TimestampType()),
        _s("duration_seconds", DoubleType()),
        _s("status"),
    ]
)

DIM_VISITOR = StructType(
    [
        _s("visitor_id"),
        _s("ip_address"),
        _s("country"),
        _s("region"),
        _s("city"),
        _s("browser"),
        _s("platform"),
        _s("mobile", BooleanType()),
    ]
)

FACT_ENGAGEMENT = StructType(
    [
        _s("engagement_id"),
        _s("media_id"),
        _s("visitor_id"),
        _s("received_at", TimestampType()),
        _s("date", DateType()),
        _s("play_count", LongType()),
        _s("play_rate", DoubleType()),
        _s("total_watch_time", DoubleType()),
        _s("watched_percent", DoubleType()),
    ]
)

CURATED = {
    "dim_media": DIM_MEDIA,
    "dim_visitor": DIM_VISITOR,
    "fact_media_engagement": FACT_ENGAGEMENT,
}

# Legacy map-shaped manifest and checkpoint documents, for reading old runs.
LEGACY_MANIFEST_MEDIA = MapType(
    StringType(),
    StructType(
        [
            _s("mode"),
            _s("checkpoint_before"),
            _s("checkpoint_after"),
            _s("pages_fetched", LongType()),
            _s("events_fetched", LongType()),
            _s("events_saved", LongType()),
        ]
    ),
)
LEGACY_MANIFEST = StructType(
    [
        _s("run_id"),
        _s("run_date"),
        _s("started_at_utc"),
        _s("finished_at_utc"),
        _s("media_ids", ArrayType(StringType())),
        _s("status"),
        _s("error"),
        _s("media", LEGACY_MANIFEST_MEDIA),
    ]
)
LEGACY_CHECKPOINT = MapType(StringType(), StructType([_s("last_received_at")]))
