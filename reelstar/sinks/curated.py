"""Curated Parquet tables and their catalog entries (K6-K8).

* No ``coalesce(1)``: that pulls the last stage of a 100 TB job into one
  task. Dimensions are written with the plan's own parallelism; the fact is
  written partitioned by ``date`` behind a ``REBALANCE`` hint, so AQE sizes
  the write tasks (splitting a hot day, merging small ones) instead of one
  task per day or many tiny files per task.
* ``maxRecordsPerFile`` bounds file size for readers.
* Tables are registered with ``CREATE TABLE ... USING parquet LOCATION``
  (the Hive ``STORED AS`` form needs Hive support).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelstar import schemas

FACT_PARTITIONS = ("date",)
MAX_RECORDS_PER_FILE = 5_000_000


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: tuple[str, ...] = (),
    mode: str = "overwrite",
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    rebalance: bool = True,
) -> None:
    """Write Parquet; with ``partition_by``, rebalance on the partition columns first.

    The rebalance costs one shuffle of the (narrow) output and bounds the file
    count: without it every write task emits one file per partition value it
    holds (tasks x days small files). Pass ``rebalance=False`` when the input
    is already clustered by the partition columns.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def table_path(curated_root: str, name: str) -> str:
    return f"{curated_root.rstrip('/')}/{name}"


def create_database(spark: SparkSession, db: str) -> None:
    """K8."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def register_tables(spark: SparkSession, db: str, curated_root: str) -> None:
    """K7: one catalog table per curated directory (idempotent)."""
    create_database(spark, db)
    for name, schema in schemas.CURATED.items():
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        part = " PARTITIONED BY (`date`)" if name == "fact_media_engagement" else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {db}.{name} ({cols}) USING parquet{part} "
            f"LOCATION '{table_path(curated_root, name)}'"
        )
        if part:
            spark.catalog.recoverPartitions(f"{db}.{name}")
