"""Readies a session: the package on the Python workers' path, and rows in batches that leave workers small."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


#: Rows handed to Python at once, where the session keeps Spark's default of 10,000: a row may be a whole text.
BATCH_ROWS = "1000"
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, and hand texts to Python in small batches.

    Nothing is sent where PYTHONPATH already names the folder that holds the package, as workers inherit it. A batch size that the
    session has set itself stays.
    """
    if spark.conf.get(_BATCH_KEY) == "10000":
        spark.conf.set(_BATCH_KEY, BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    name = Path(tempfile.mkdtemp(prefix="tidelake-")) / "tidelake.zip"
    with zipfile.ZipFile(name, "w") as out:
        for file in sorted((ROOT / "tidelake").rglob("*.py")):
            out.write(file, file.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(name))
