"""A5: entity-attribute-value rows turned into columns in one pass.

The reference joins the EAV table once per property (five scans, five shuffles).  One
aggregation reads it once and shuffles it once by entity, keeping the list of values of every
property; the lists are then expanded, so an entity that holds a property twice gives one row
per combination, exactly like the joins.  ``duplicate_properties`` reports such entities.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_properties(eav: DataFrame, key: str, property_col: str,
                     wanted: Mapping[str, tuple[object, str]]) -> DataFrame:
    """``wanted``: output column -> (property id, value column).  A NULL property id (the
    definition was not found) yields an all-NULL column, like the join on ``= NULL``."""
    ids = [pid for pid, _ in wanted.values() if pid is not None]
    rows = eav.filter(F.col(property_col).isin(ids)) if ids else eav.limit(0)
    held = rows.groupBy(key).agg(*[
        F.collect_list(F.when(F.col(property_col) == F.lit(pid), F.struct(F.col(value_col).alias("v")))).alias(out)
        for out, (pid, value_col) in wanted.items()])
    for out in wanted:
        held = held.withColumn(out, F.explode_outer(out))
    return held.select(key, *[F.col(out)["v"].alias(out) for out in wanted])


def duplicate_properties(eav: DataFrame, key: str, property_col: str) -> DataFrame:
    """Entities holding one property more than once (where the join form would fan out)."""
    return (eav.groupBy(key, property_col)
               .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
