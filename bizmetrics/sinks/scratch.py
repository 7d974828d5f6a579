"""A folder for intermediate tables that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Where that is not set, a local session gets a temporary folder of this machine, removed at exit; on a cluster
    each machine would have its own, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        folder = tempfile.mkdtemp(prefix="bizmetrics-scratch-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        base = f"file://{folder}"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"
