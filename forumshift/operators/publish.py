"""A run becomes visible as a whole or not at all.

Only what a run added or changed is written: plain Parquet tables below ``<root>/<run>``.  The
last thing written is ``STATUS.json``, which lists the folders of every table -- the unchanged
input folder and the run's own part, or the rewritten table alone.  A run without that file does
not exist for readers; nothing is renamed, replaced or deleted.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

STATUS = "STATUS.json"


def publish(spark: SparkSession, changed: dict[str, DataFrame], unchanged: dict[str, str | list[str]], root: str, run: str) -> dict:
    """Write ``changed`` and list it with the ``unchanged`` folders (table -> path or paths)."""
    tables = {name: [paths] if isinstance(paths, str) else list(paths) for name, paths in unchanged.items()}
    for name, df in changed.items():
        path = f"{root}/{run}/{name}"
        df.write.mode("errorifexists").parquet(path)
        tables.setdefault(name, []).append(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{run}/{STATUS}")
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, False)
    try:
        out.write(bytearray(json.dumps({"run": run, "tables": tables}).encode("utf-8")))
    finally:
        out.close()
    return tables


def listed(spark: SparkSession, root: str, run: str) -> dict[str, list[str]]:
    """Table -> folders of a published run; raises for a run that was not completed."""
    return json.loads("".join(r.value for r in spark.read.text(f"{root}/{run}/{STATUS}").collect()))["tables"]


def read_published(spark: SparkSession, root: str, run: str) -> dict[str, DataFrame]:
    """The tables of a published run."""
    out = {}
    for name, paths in listed(spark, root, run).items():
        parts = [spark.read.parquet(p) for p in paths]
        columns = parts[-1].columns
        out[name] = parts[0].select(*columns)
        for p in parts[1:]:
            out[name] = out[name].unionByName(p)
    return out
