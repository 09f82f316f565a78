"""Session construction and the shared folder used to cut lineage.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(an HDFS/S3/ABFS path every executor can reach). We only invent one when the
setting is absent *and* the master is local (tests, laptop runs); a cluster
without the setting is a configuration error, never a silent fallback to a
machine-local temporary folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans at every shuffle boundary:
# it coalesces small partitions, splits skewed join partitions and turns a
# sort-merge join into a broadcast join when the *measured* size of a side
# is under the threshold, so broadcasts are always size-checked at runtime.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerspark", extra: dict | None = None) -> SparkSession:
    """Local/test session with the scale settings above."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("LEDGERSPARK_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share for checkpoints and materialised marts.

    Read from the session (``spark.checkpoint.dir`` or the SparkContext's
    checkpoint dir). Only a local master gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a folder every executor can reach")
        d = tempfile.mkdtemp(prefix="ledgerspark-ckpt-")
    sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() or d).rstrip("/")
