"""Fresh folders that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def workspace(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir`` (a temporary folder where it is unset); removed at exit."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone by now
        pass
