"""Session construction.

Every setting here is a semantic or scale decision, not a tuning guess:

* ``spark.sql.session.timeZone=UTC`` — ``to_date`` of an event timestamp is the
  calendar day in the session zone; pinning UTC makes the fact's ``date``
  independent of where the driver runs.
* AQE on, with skew-join splitting: the media key has ~100 distinct values
  while events number in the billions at scale, so any shuffle on ``media_id``
  is skewed by construction. AQE splits the hot partitions at run time, also
  where that costs a new shuffle behind the join (``forceOptimizeSkewedJoin``).
  Without that, joins and aggregations stacked on one key are not split.
* ``partitionColumnTypeInference`` off: landed paths carry ids such as
  ``media_id=0123`` which must stay strings.
* ``spark.sql.autoBroadcastJoinThreshold`` is the size check for broadcast: a
  dimension is broadcast only when its estimated size is under it, with a
  sort-merge join beyond it; AQE re-checks with run-time sizes.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for a cluster; tests and bench override the partition counts.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "reelstar",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's required settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Runtime-settable SQL confs also apply when the session already existed.
    for key, value in conf.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared directory for lineage cuts and staged tables.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``;
    only when it is unset (local tests) a scratch directory is created.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                "(a machine-local directory would be lost with its executor)"
            )
        configured = tempfile.mkdtemp(prefix="reelstar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged table of our own (nothing happens when it is missing)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
