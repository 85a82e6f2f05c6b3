"""Sends this package to the executors, which need not have it on their path."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Rows go to Python in batches of about as many bytes, so that workers' memory doesn't follow row sizes.
BATCH_BYTES = 3 << 20

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package to the session's Python files, once per application, and bound its Arrow batches; returns the session."""
    sc = spark.sparkContext
    if _BATCH not in spark.conf.getAll:  # what the session was given stays
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    if sc.applicationId not in _sent:
        root = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="dialoom-")  # the driver's own: Spark serves the file to the executors
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        target = Path(folder) / "dialoom.zip"
        with zipfile.ZipFile(target, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(target))
        _sent.add(sc.applicationId)
    return spark
