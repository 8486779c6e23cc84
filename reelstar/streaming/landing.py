"""Structured Streaming forms of landing and dedup.

These differ from the batch landing on purpose:

* the file source tracks *files seen* in its checkpoint (not a per-media
  maximum timestamp), so a late event in a new file is never lost, and a
  rerun over the same files adds nothing;
* ``dropDuplicatesWithinWatermark`` keeps dedup state only for the
  watermark horizon (bounded state), whereas ``dropDuplicates`` without a
  watermark is exact but keeps every key forever. Copies that arrive further
  apart than the horizon are removed by the batch transform's dedup, which
  re-reads all history, or at once with ``key_index``: each micro-batch is
  held against a key index on the shared store instead of a state in memory,
  so the stream keeps no state, its output is exact, and a first delivery that
  comes late is not dropped either.

``trigger(availableNow=True)`` processes what is there and stops, which is
the scheduled-job shape of the reference, with exactly-once file tracking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelstar import schemas
from reelstar.functions import columns as fn
from reelstar.operators.latest import dedup
from reelstar.sinks.key_index import DAY, KEY, KeyIndex, key_of
from reelstar.sources.json_layout import scan_stream, split_corrupt
from reelstar.sources.raw import EVENTS_GLOB, with_path_media, with_run

EVENT_TIME = "event_time"


def read_event_stream(spark: SparkSession, raw_root: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """X6 source: landed event files as an unbounded table.

    The layout of each file is found from its text and malformed records are
    left out, as in the batch reader.
    """
    path = f"{raw_root.rstrip('/')}/{EVENTS_GLOB}"
    found = with_path_media(scan_stream(spark, path, schemas.RAW_EVENT, max_files_per_trigger=max_files_per_trigger))
    df = split_corrupt(found)[0]
    # Event time must be TIMESTAMP (not NTZ) for a watermark; parsing the ISO
    # string with the session pinned to UTC gives exactly that.
    return with_run(df).withColumn(EVENT_TIME, fn.parse_ts("received_at"))


def dedup_stream(events: DataFrame, watermark: str = "2 days") -> DataFrame:
    """Stream dedup on ``event_key`` with state bounded by the watermark."""
    return events.withWatermark(EVENT_TIME, watermark).dropDuplicatesWithinWatermark(["event_key"])


def start_landing_stream(
    spark: SparkSession,
    raw_root: str,
    out_path: str,
    checkpoint_location: str,
    *,
    watermark: str | None = "2 days",
    available_now: bool = True,
    key_index: str | None = None,
) -> StreamingQuery:
    """Stream landed events into a Parquet event table (append, exactly-once).

    ``foreachBatch`` writes each micro-batch with ordinary batch writers into
    its own ``batch_id=N`` directory in overwrite mode, so a batch replayed
    after a failure replaces its earlier partial output instead of doubling it.

    With ``key_index`` (a path) no copy is written however late it comes, and
    ``watermark`` has no part: a batch leaves out its own copies and the keys
    that other batches brought. A replayed batch does not count its own earlier keys, so
    it writes the same rows again. Records without a key are one key.
    """
    events = read_event_stream(spark, raw_root)
    if watermark and not key_index:
        events = dedup_stream(events, watermark)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if key_index:
            index, origin = KeyIndex(batch.sparkSession, key_index), str(batch_id)
            keyed = dedup(batch, "event_key", [F.col(EVENT_TIME).desc_nulls_last()]).withColumn(KEY, key_of("event_key"))
            batch = index.unknown(keyed, other_than=origin)
            index.add(keyed.select(KEY, F.to_date(EVENT_TIME).alias(DAY)), origin)
            batch = batch.select(*events.columns)
        batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    writer = events.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
