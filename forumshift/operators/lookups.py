"""Uncorrelated scalar lookups: values looked up once for a whole run.

All lookups of a step are resolved by ONE job: a one-row select of scalar subqueries.
The engine enforces the reference's cardinality rule -- no row gives NULL, more than one
row raises ``SCALAR_SUBQUERY_TOO_MANY_ROWS`` -- and the values come back as Python
literals, so later plans see constants (constant folding, parquet pushdown, partition
pruning on ``BoardID``) instead of subqueries.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class LookupError_(RuntimeError):
    pass


def resolve(spark: SparkSession, lookups: Mapping[str, DataFrame], required: tuple[str, ...] = ()) -> dict[str, Any]:
    """Each lookup is a DataFrame of exactly one column; returns name -> value (None if empty)."""
    if not lookups:
        return {}
    for name, df in lookups.items():
        if len(df.columns) != 1:
            raise ValueError(f"lookup {name} must select one column, got {df.columns}")
    row = spark.range(1).select(*[df.scalar().alias(name) for name, df in lookups.items()]).first()
    values = row.asDict()
    missing = [n for n in required if values.get(n) is None]
    if missing:
        raise LookupError_(f"required lookups returned no row: {missing}")
    return values

