"""Where jobs put tables they need on the way."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_base() -> str:
    """One temporary folder per process, deleted when it ends."""
    base = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new directory in the shared folder the cluster names in ``spark.checkpoint.dir``. Only a
    local session that names none gets a temporary one. What is in the shared folder stays there as long as its owner
    wants: results are read from it whenever they are needed."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
