"""Index of known event keys, bucketed by key.

An incremental merge and an exact stream dedup both ask which of some new keys
are known already, and since which day. The index answers by a join that moves
the new keys only: its Parquet files are bucketed by the key, so the planner
joins bucket by bucket without shuffling what is stored (and beyond Spark's
runtime-filter thresholds drops stored rows by a Bloom filter of the new keys
before they are sorted). It holds a key, a day and the batch that brought it
for every delivery that was new; never the events.

Keys are added before the events they stand for are written. A crash between
the two leaves the index with more than is stored, which only makes the next
merge look at a day too many; the other order would lose sight of a copy.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY, DAY, ORIGIN = "key", "day", "origin"
SCHEMA = f"{KEY} string, {DAY} date, {ORIGIN} string"


def key_of(event_key: str) -> Column:
    """The key as stored: never null, so that joins need no null-safe form (which would not match the buckets)."""
    return F.coalesce(F.concat(F.lit("="), F.col(event_key)), F.lit(""))


class KeyIndex:
    """A bucketed table at ``path``; ``buckets`` counts when it is first written (the shuffle partitions by default)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.name = "reelstar_keys_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        self._wanted = buckets

    def _stored_buckets(self) -> int | None:
        try:
            row = self.spark.read.text(f"{self.path}.buckets").first()
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc):
                return None
            raise
        return int(row[0]) if row else None

    def exists(self) -> bool:
        return self._stored_buckets() is not None

    def table(self) -> DataFrame:
        """The index; created empty at its first use, registered in the session's catalog."""
        buckets = self._stored_buckets()
        if buckets is None:
            buckets = self._wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self.spark.range(1).select(F.lit(str(buckets)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{self.path}.buckets")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({SCHEMA}) USING parquet "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """New rows dealt to the stored buckets: the side that moves."""
        return rows.repartition(self._stored_buckets(), KEY)

    def known(self, keys: DataFrame, *, other_than: str | None = None) -> DataFrame:
        """Index rows (key, day) of ``keys`` (a column ``key``), without those that the batch ``other_than`` brought."""
        rows = self.table()
        if other_than is not None:
            rows = rows.where(F.col(ORIGIN).isNull() | (F.col(ORIGIN) != other_than))
        return rows.join(self._dealt(keys.select(KEY)).distinct(), KEY, "left_semi").select(KEY, DAY)

    def unknown(self, rows: DataFrame, *, other_than: str) -> DataFrame:
        """Those of ``rows`` (with a column ``key``) whose key no other batch brought."""
        known = self.table().where(F.col(ORIGIN).isNull() | (F.col(ORIGIN) != other_than)).select(KEY)
        return self._dealt(rows).join(known, KEY, "left_anti")

    def add(self, rows: DataFrame, origin: str | None = None) -> None:
        """Adds the (key, day) pairs that are not in the index yet; one file a bucket."""
        stored = self.table()
        pairs = self._dealt(rows.select(KEY, DAY)).distinct()
        same_day = F.coalesce(F.col(f"s.{DAY}"), F.lit("0001-01-01").cast("date")) == F.coalesce(F.col(f"n.{DAY}"), F.lit("0001-01-01").cast("date"))
        fresh = pairs.alias("n").join(stored.alias("s"), (F.col(f"s.{KEY}") == F.col(f"n.{KEY}")) & same_day, "left_anti")
        self._dealt(fresh.select(KEY, DAY, F.lit(origin).cast("string").alias(ORIGIN))).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
