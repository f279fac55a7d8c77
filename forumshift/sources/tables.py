"""Reading the migration's tables with their fixed schemas.

One parquet folder per table under a root (``<root>/<name>``), e.g. an export of the portal
database.  A column that the schema names and the folder lacks raises at read time.  Targets
keep the lineage column of an earlier run where they have one, so a second run of the same
module is recognised.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..schemas import LINEAGE, SOURCES, TARGETS, conform, target_schema


def read_tables(spark: SparkSession, root: str, names: Iterable[str], schemas: dict | None = None,
                fmt: str = "parquet") -> dict[str, DataFrame]:
    schemas = schemas or {**SOURCES, **TARGETS}
    return {name: conform(spark.read.format(fmt).load(f"{root}/{name}"), schemas[name], name=name) for name in names}


def read_sources(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return read_tables(spark, root, SOURCES, SOURCES)


def read_targets(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    out = {}
    for name in TARGETS:
        df = spark.read.parquet(f"{root}/{name}")
        held = LINEAGE.get(name, "").lower() in {c.lower() for c in df.columns}
        out[name] = conform(df, target_schema(name, with_lineage=held), name=name)
    return out
