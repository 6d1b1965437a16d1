"""Folders for tables that a query makes for itself."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import SparkSession

from .sources.files import files_of

_own: dict[str, str] = {}


def _clean(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the application may be gone already
        files_of(spark, path).delete("")


def fresh_root(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place of spark.checkpoint.dir; in a temporary one of ours only where that is unset and all runs in one process.

    It goes when the driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster, tables in between need a folder that all machines share")
    if not base:
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="tidelake-")
            atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
        base = _own[app]
    path = f"{base.rstrip('/')}/lakes/{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(_clean, spark, path)
    return path
