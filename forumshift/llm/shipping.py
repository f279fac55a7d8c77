"""Makes this package importable in the executors' Python workers."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import forumshift

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application (as ``--py-files`` would)."""
    app = spark.sparkContext.applicationId
    if app not in _SENT:
        root = Path(forumshift.__file__).resolve().parent
        out = tempfile.mkdtemp(prefix="forumshift-package-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{out}/forumshift-{app}", "zip", root.parent, root.name))
        _SENT.add(app)


def arrow_map(df: DataFrame, run: Callable, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
