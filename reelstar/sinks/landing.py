"""Raw landing writers (K1-K5) and the versioned landing state.

Landed files keep the raw layout the readers expect, one directory per run::

    <raw>/run_date=D/run_id=R/events/media_id=M/part-*        (JSON lines)
    <raw>/run_date=D/run_id=R/media_metadata.json/part-*.json
    <raw>/run_date=D/run_id=R/media_stats/media_id=M/part-*.json
    <raw>/run_date=D/run_id=R/run_manifest.json/part-*.json
    <raw>/run_date=D/run_id=R/run_header.json/part-*.json

State is never overwritten in place (the next state is computed *from* the
current one, so overwriting the path being read would lose it): each run
writes ``<state>/version=<run_id>/``, then moves the one-line pointer
``<state>/latest`` to it, and readers follow the pointer. A failed run moves
nothing, so the previous marks stay in force and the next run re-lands
(at-least-once; dedup removes the copies downstream).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas
from reelstar.session import remove_path


def run_prefix(raw_root: str, run_id: str, run_date: str) -> str:
    return f"{raw_root.rstrip('/')}/run_date={run_date}/run_id={run_id}"


def write_json(df: DataFrame, path: str, *, partition_by: tuple[str, ...] = (), mode: str = "append") -> None:
    """K1: JSON lines (one record per line, splittable on read)."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def land_events(saved: DataFrame, raw_root: str, run_id: str, run_date: str) -> None:
    """K2: saved events under the run, one directory per media.

    The record keeps its ``media_id``; the directory is named by a copy, which
    may be escaped. A rebalance on the media first keeps the files few and
    splits a hot media over several of them.
    """
    record = F.to_json(F.struct(*saved.columns), {"ignoreNullFields": "false"}).alias("value")
    lines = saved.select(record, "media_id").hint("rebalance", "media_id")
    lines.write.mode("append").partitionBy("media_id").text(f"{run_prefix(raw_root, run_id, run_date)}/events")


def land_metadata(metadata: DataFrame, raw_root: str, run_id: str, run_date: str) -> None:
    """K3: the run's media-metadata snapshot."""
    write_json(metadata, f"{run_prefix(raw_root, run_id, run_date)}/media_metadata.json")


def land_stats(stats: DataFrame, raw_root: str, run_id: str, run_date: str) -> None:
    """K3: one stats object per media (``media_id`` + payload columns)."""
    write_json(stats, f"{run_prefix(raw_root, run_id, run_date)}/media_stats", partition_by=("media_id",))


def land_manifest(manifest: DataFrame, raw_root: str, run_id: str, run_date: str) -> None:
    """K5: one manifest row per (run, media)."""
    write_json(manifest, f"{run_prefix(raw_root, run_id, run_date)}/run_manifest.json", mode="overwrite")


def land_header(header: DataFrame, raw_root: str, run_id: str, run_date: str) -> None:
    """K5: the run itself, beside its manifest; both stand before the run's marks are committed."""
    write_json(header, f"{run_prefix(raw_root, run_id, run_date)}/run_header.json", mode="overwrite")


class StateStore:
    """Versioned per-media high-water marks behind one pointer.

    ``keep`` versions stay readable; older ones, and versions of failed runs
    behind the latest, are removed after each commit.
    """

    VERSION = "version"
    COMMITS = "_commits"  # marks of stores written before there was a pointer
    POINTER = "latest"

    def __init__(self, spark: SparkSession, root: str, keep: int = 5):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = max(1, keep)

    def _texts(self, path: str) -> DataFrame:
        try:
            return self.spark.read.text(path)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc):
                return self.spark.createDataFrame([], "value string")
            raise

    def latest(self) -> str | None:
        """The committed version; None before the first run."""
        pointed = self._texts(f"{self.root}/{self.POINTER}").first()
        return pointed[0] if pointed else self._texts(f"{self.root}/{self.COMMITS}/*").agg(F.max("value")).first()[0]

    def read(self) -> DataFrame:
        """The latest committed state; an empty frame on the first run."""
        latest = self.latest()
        if latest is None:
            return self.spark.createDataFrame([], schemas.STATE)
        return self.spark.read.schema(schemas.STATE).parquet(f"{self.root}/{self.VERSION}={latest}")

    def write(self, state: DataFrame, version: str) -> None:
        """K4: publish a new version (fails rather than replace or precede a committed one)."""
        latest = self.latest()
        if latest is not None and version <= latest:
            raise FileExistsError(f"state version {version} already exists or precedes the committed {latest}")
        state.select("media_id", "last_received_at").write.mode("overwrite").parquet(f"{self.root}/{self.VERSION}={version}")
        self._point_to(version)
        self._prune(version)

    def _point_to(self, version: str) -> None:
        # The pointer is written aside and renamed over the old one: a reader
        # finds either, never a part of one.
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        pointer, aside = (jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}") for name in (self.POINTER, f"{self.POINTER}.{version}"))
        out = pointer.getFileSystem(conf).create(aside, True)
        out.write(bytearray(version.encode()))
        out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), conf).rename(aside, pointer, options)

    def _prune(self, committed: str) -> None:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = sorted(s.getPath().getName() for s in fs.listStatus(root))
        versions = [n for n in found if n.startswith(f"{self.VERSION}=") and n <= f"{self.VERSION}={committed}"]
        for name in versions[: -self.keep]:
            remove_path(self.spark, f"{self.root}/{name}")
