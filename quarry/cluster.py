"""Makes this package importable in Spark's Python workers, wherever they run."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors with the context's own file server, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent
    handle, name = tempfile.mkstemp(prefix="quarry-", suffix=".zip")  # read by the driver only, which serves it
    os.close(handle)
    atexit.register(lambda: os.path.exists(name) and os.remove(name))
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, f"{home.name}/{p.relative_to(home)}")
    sc.addPyFile(name)
    _shipped.add(sc.applicationId)
