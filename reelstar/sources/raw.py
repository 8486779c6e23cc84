"""Readers for the landed raw layout (S1-S6) and the curated tables.

Layout under a raw root (one directory per run, all runs are read — a bag
union of history, failed runs included)::

    run_date=YYYY-MM-DD/run_id=YYYYMMDDTHHMMSSZ/
        events/media_id=<id>/<file>.json
        media_metadata.json            (a file, or a directory of part files)
        media_stats/<id>.json          (or media_stats/media_id=<id>/<file>.json)
        run_manifest.json
        run_header.json

Partition discovery is deliberately *not* used: the plain ``events/`` level
between the ``k=v`` levels makes Spark reject the tree once two runs exist,
and with one run the path value would silently override the payload. Run
and media ids are taken from ``_metadata.file_path`` by regex instead.

The layout of a file (JSON lines, array pages, pretty-printed documents) is
found from its text, see :mod:`reelstar.sources.json_layout`. Malformed records
of any of the three kinds are no rows; they can be kept and set aside.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelstar import schemas
from reelstar.functions import columns as fn
from reelstar.sources.json_layout import CORRUPT, scan, split_corrupt

ALL_RUNS = "run_date=*/run_id=*"
EVENTS_GLOB = f"{ALL_RUNS}/events/media_id=*/*"
METADATA_GLOB = f"{ALL_RUNS}/media_metadata.json"
STATS_GLOB = f"{ALL_RUNS}/media_stats/*"
MANIFEST_GLOB = f"{ALL_RUNS}/run_manifest.json"
HEADER_GLOB = f"{ALL_RUNS}/run_header.json"

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: directory of a null partition key


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    *,
    allow_missing: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON with an explicit schema plus the source path.

    Unknown fields are ignored. Malformed records are left out, or with
    ``keep_corrupt`` kept with their text in ``_corrupt_record``. With
    ``allow_missing`` an empty glob gives an empty typed frame instead of
    ``PATH_NOT_FOUND`` (first run).
    """
    found = scan(spark, path, schema, allow_missing=allow_missing)
    return found if keep_corrupt else split_corrupt(found)[0]


def counted(found: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A scan that counts its records and malformed records while it is read."""
    totals = Observation(name)
    corrupt = F.count_if(F.col(CORRUPT).isNotNull()) if CORRUPT in found.columns else F.lit(None).cast("long")
    return found.observe(totals, F.count(F.lit(1)).alias("records"), corrupt.alias("malformed")), totals


def with_run(df: DataFrame) -> DataFrame:
    """``run_id`` / ``run_date`` from the landed path ("" when absent)."""
    return df.withColumn("run_id", fn.run_id_from_path("_source_file")).withColumn(
        "run_date", fn.from_path("_source_file", fn.RUN_DATE_FROM_PATH)
    )


def events_media_from_path(path: F.Column | str) -> F.Column:
    """Media id of an event file's directory: unescaped, null for the null partition.

    Paths come URL-escaped, and directory names are escaped once more by the writer.
    """
    found = fn.from_path(path, fn.EVENTS_MEDIA_FROM_PATH)
    return F.when(found != NULL_PARTITION, _unescaped(_unescaped(found)))


def _unescaped(text: F.Column) -> F.Column:
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def stats_media_id(path: F.Column | str) -> F.Column:
    """Media id of a stats file: ``media_stats/<id>.json`` or ``media_id=<id>/``."""
    legacy = fn.stats_media_from_path(path)
    partitioned = events_media_from_path(path)
    return F.when(legacy != "", legacy).otherwise(partitioned)


def scan_events(
    spark: SparkSession,
    raw_root: str,
    *,
    allow_missing: bool = False,
    runs: str = ALL_RUNS,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Every landed event of the selected runs (all by default). Payload
    ``media_id`` wins; the path id fills in for ``partitionBy('media_id')`` files.
    ``runs`` narrows the glob (e.g. ``run_date=2024-02-01/run_id=*``) so an
    incremental run lists and reads only the new run directories. Malformed
    records are no events: they are left out, or with ``keep_corrupt`` kept with
    their text in ``_corrupt_record``, to be counted and set aside
    (see :func:`split_corrupt`)."""
    glob = EVENTS_GLOB.replace(ALL_RUNS, runs, 1)
    found = read_json(spark, f"{raw_root.rstrip('/')}/{glob}", schemas.RAW_EVENT, allow_missing=allow_missing, keep_corrupt=True)
    found = with_path_media(found)
    return found if keep_corrupt else split_corrupt(found)[0]


def with_path_media(events: DataFrame) -> DataFrame:
    """``media_id`` of the record, else of its directory; a malformed record has none."""
    from_path = F.when(F.col(CORRUPT).isNull(), events_media_from_path("_source_file"))
    return events.withColumn("media_id", F.coalesce("media_id", from_path))


def scan_metadata(spark: SparkSession, raw_root: str, *, allow_missing: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """S3: every media-metadata snapshot; a malformed record is no media."""
    path = f"{raw_root.rstrip('/')}/{METADATA_GLOB}"
    return read_json(spark, path, schemas.RAW_METADATA, allow_missing=allow_missing, keep_corrupt=keep_corrupt)


def scan_stats(spark: SparkSession, raw_root: str, *, allow_missing: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """One stats object per media per run; a malformed one leaves the media's earlier rate in force."""
    path = f"{raw_root.rstrip('/')}/{STATS_GLOB}"
    return read_json(spark, path, schemas.RAW_STATS, allow_missing=allow_missing, keep_corrupt=keep_corrupt)


def scan_manifests(spark: SparkSession, raw_root: str, *, allow_missing: bool = True) -> DataFrame:
    return read_json(spark, f"{raw_root.rstrip('/')}/{MANIFEST_GLOB}", schemas.MANIFEST, allow_missing=allow_missing)


def scan_runs(spark: SparkSession, raw_root: str, *, allow_missing: bool = True) -> DataFrame:
    """The header of every run: start, finish, status, totals."""
    return read_json(spark, f"{raw_root.rstrip('/')}/{HEADER_GLOB}", schemas.RUN_HEADER, allow_missing=allow_missing)


def read_curated(spark: SparkSession, curated_root: str, name: str) -> DataFrame:
    """A curated Parquet table (vectorised scan, filter/column pushdown)."""
    return spark.read.schema(schemas.CURATED[name]).parquet(f"{curated_root.rstrip('/')}/{name}")


def read_legacy_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """S8 for the single-document checkpoint (``{media_id: {last_received_at}}``).

    Returns one row per media (an empty frame when the document is missing),
    so an existing deployment can seed :class:`reelstar.sinks.landing.StateStore`.
    """
    try:
        doc = spark.read.text(path, wholetext=True)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return _empty(spark, schemas.STATE)
        raise
    entries = doc.select(F.explode(F.from_json("value", schemas.LEGACY_CHECKPOINT)).alias("media_id", "v"))
    return entries.select("media_id", F.col("v.last_received_at").alias("last_received_at"))


def read_legacy_manifests(spark: SparkSession, raw_root: str) -> DataFrame:
    """Run manifests in the map-per-run form, flattened to one row per (run, media)."""
    try:
        docs = spark.read.text(f"{raw_root.rstrip('/')}/{MANIFEST_GLOB}", wholetext=True)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return _empty(spark, schemas.MANIFEST)
        raise
    m = docs.select(F.from_json("value", schemas.LEGACY_MANIFEST).alias("m")).select("m.*")
    rows = m.select("run_id", "run_date", "status", "error", F.explode_outer("media").alias("media_id", "s"))
    return rows.select(
        "run_id",
        "run_date",
        "media_id",
        F.col("s.mode").alias("mode"),
        F.col("s.checkpoint_before").alias("checkpoint_before"),
        F.col("s.checkpoint_after").alias("checkpoint_after"),
        F.col("s.pages_fetched").alias("pages_fetched"),
        F.col("s.events_fetched").alias("events_fetched"),
        F.col("s.events_saved").alias("events_saved"),
        F.lit(None).cast("long").alias("events_rejected"),
        "status",
        "error",
    )
