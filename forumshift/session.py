"""Session helpers: the settings every run relies on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",          # NTZ everywhere; no zone-dependent casts
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",  # hot authors / topics / messages
    # A broadcast passes through the driver.  Parquet sizes say little about rows in memory (files of
    # repeated values are a small part of them), so joins go by sizes measured at run time.
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m",
    "spark.sql.optimizeNullAwareAntiJoin": "true",  # NOT IN (J4)
    "spark.sql.ansi.enabled": "true",               # bad casts fail the run like the reference
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "forumshift", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_run_conf(spark: SparkSession) -> None:
    """Settings that are safe to change on a live session (the driver hands us one)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
              "spark.sql.optimizeNullAwareAntiJoin"):
        try:
            spark.conf.set(k, BASE_CONF[k])
        except Exception:  # pragma: no cover - static conf on some deployments
            pass


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset is ``fallback`` used, or in local mode, where
    driver and tasks are one process, a scratch folder.  On a cluster this raises instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    chosen = conf or fallback
    if not chosen and (sc.master.startswith("local[") or sc.master == "local"):
        chosen = tempfile.mkdtemp(prefix="forumshift-")     # one process: its folder is everyone's
    if not chosen:
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required to cut lineage")
    sc.setCheckpointDir(chosen)
    return sc.getCheckpointDir() or chosen


def local_test_session(checkpoint: str | None = None, partitions: int = 8) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    extra = {"spark.driver.memory": "8g"}
    if checkpoint:
        extra["spark.checkpoint.dir"] = checkpoint
    return build_session(f"local[{cpus}]", shuffle_partitions=partitions, extra=extra)
