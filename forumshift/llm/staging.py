"""Written intermediates in the shared folder named by ``spark.checkpoint.dir``.

A staged table is plain Parquet, so it survives lost executors and cuts lineage.  The folder
is read from the session; only a local session without one gets a scratch folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from forumshift.session import checkpoint_dir

_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    return checkpoint_dir(spark).rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def stage(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and return it reread."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged() -> list[str]:
    """The folders that this process has staged and not dropped, in order."""
    return list(_MADE)


def drop_stages(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Remove staged folders, by default all of this process; call it once the results are written."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in staged() if paths is None else paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        _MADE.remove(path)
