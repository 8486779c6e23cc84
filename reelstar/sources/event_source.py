"""An event source stored by day, fetched from a day bound found at run time.

The landing job asks its source only for the days that its marks leave open.
Here the source is a table partitioned by the calendar day of the receive
time, so that bound becomes a literal partition filter: directories of earlier
days are not listed as input at all. Events without a usable time stand in the
null partition, which every fetch reads (they cannot be filtered by day). Media
without a usable mark need all days; only when a run has such media is the
table read once more, for them alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from reelstar.functions import columns as fn

DAY = "event_day"


@dataclass
class DatedSource:
    spark: SparkSession
    path: str
    schema: StructType  # of the events, without the day

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @classmethod
    def write(cls, events: DataFrame, path: str, mode: str = "append") -> DatedSource:
        """Adds ``events`` to the source; a hot day is split over several files."""
        dated = events.withColumn(DAY, fn.event_date(fn.parse_ts("received_at"))).hint("rebalance", DAY)
        dated.write.mode(mode).partitionBy(DAY).parquet(path)
        return cls(events.sparkSession, path, events.schema)

    def _stored(self) -> DataFrame:
        stored = StructType([*self.schema.fields, StructField(DAY, DateType(), True)])
        return self.spark.read.schema(stored).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(DAY)

    def fetch(self, known: DataFrame, own: Column, from_instant: Column) -> DataFrame:
        """Events joined to ``known`` (one row a media), of the days that ``from_instant`` leaves open.

        ``own`` is the media id in ``known``; ``from_instant`` is null for media
        that need all days. The bound is one row: the earliest day asked for and
        whether any media needs all.
        """
        match = F.col("media_id").eqNullSafe(own)
        bound = known.agg(F.min(F.to_date(from_instant)).alias("day"), F.count_if(from_instant.isNull()).alias("open")).first()
        parts = []
        if bound["day"] is not None:
            days = self._stored().where((F.col(DAY) >= F.lit(bound["day"])) | F.col(DAY).isNull())
            parts.append(days.join(known.where(from_instant.isNotNull()), match))
        if bound["open"] or not parts:
            parts.append(self._stored().join(known.where(from_instant.isNull()), match))
        found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return found.drop(DAY)
