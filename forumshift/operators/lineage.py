"""temporary lineage columns holding the source id of each migrated row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_lineage(df: DataFrame, column: str) -> DataFrame:
    """F37 ``IF NOT EXISTS (column) ALTER TABLE ADD column int NULL`` (names compare case-blind)."""
    if column.lower() in (c.lower() for c in df.columns):
        return df
    return df.withColumn(column, F.lit(None).cast("bigint"))


def drop_lineage(df: DataFrame, column: str) -> DataFrame:
    """F38 ``IF EXISTS (column) ALTER TABLE DROP COLUMN``."""
    match = [c for c in df.columns if c.lower() == column.lower()]
    return df.drop(*match) if match else df
