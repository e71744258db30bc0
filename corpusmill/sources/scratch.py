"""The folder that all machines of a session see, and what has been written there."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_WRITTEN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset a local session gets a temporary folder, which goes
    when Python ends; on a cluster there is no folder that all machines see, so it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-corpusmill-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, to be removed by `release`."""
    path = os.path.join(shared_folder(spark), f"corpusmill-{name}-{uuid.uuid4().hex}")
    _WRITTEN.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Remove what was written to the paths given so far, once the results have been read; returns their number."""
    jvm, n = spark._jvm, 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n
