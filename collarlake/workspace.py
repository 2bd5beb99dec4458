"""Where jobs may write files that only they need."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="collarlake-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only for a local master without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
