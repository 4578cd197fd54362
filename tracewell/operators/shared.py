"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.

    Where the setting is absent and Spark runs in one local process, a temporary
    folder is made and set; on a cluster its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not (spark.sparkContext.master or "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="tracewell-")
    spark.sparkContext.setCheckpointDir(root)
    return root
