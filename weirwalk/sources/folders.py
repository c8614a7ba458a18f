"""Folders that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="weirwalk-")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder name under spark.checkpoint.dir, for tables that a job writes and reads again.

    Where that is unset, a local session gets a folder of its own; on a cluster the
    executors would each write to their own disk, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_dir()
    return f"{root.rstrip('/')}/weirwalk-{uuid.uuid4().hex}"
