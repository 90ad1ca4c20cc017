"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile
from pathlib import Path

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import simmart

# Runtime SQL settings. The forced skew join matters because the reporting
# views aggregate on the key they have just joined on: without it AQE leaves a
# hot key in one task rather than add the extra shuffle that splitting costs.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings and let Python workers run this package's
    functions without having it installed."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    cloudpickle.register_pickle_by_value(simmart)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it. Only a local
    session, as in tests, may leave it unset: a temporary folder serves it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set; name a folder all executors can reach")
        named = Path(tempfile.mkdtemp(prefix="simmart-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of a stage that is no longer read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
