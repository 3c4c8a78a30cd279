"""Makes the package importable on executors that don't have it installed."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    root = Path(__file__).resolve().parents[2]
    handle, path = tempfile.mkstemp(prefix="millrace-", suffix=".zip")
    os.close(handle)
    atexit.register(lambda: os.path.exists(path) and os.unlink(path))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted((root / "millrace").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(path)
    _sent.add(sc.applicationId)


def shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    return run
