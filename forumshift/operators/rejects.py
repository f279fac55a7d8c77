"""Which join a source row fails.

An inner-join statement drops a row at the first lookup that has no row for it.  ``first_failure``
runs the same lookups as marked left joins, in the statement's order, and names that lookup.  Every
source row comes out once, so counts by reason add up to the source.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REASON = "Reason"
_HIT, _SPREAD = "_fs_hit", "_fs_spread"
_LANES = 1024


@dataclass(frozen=True)
class Lookup:
    """Rows whose ``key`` value must be among ``rows[column]``; further columns of ``rows`` are carried
    on, for later lookups to use as keys.  ``rows`` has a key once."""
    reason: str
    key: str
    rows: DataFrame
    column: str


def first_failure(source: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """``source`` with ``Reason``: the first lookup without a row for it, NULL if there is none.

    A row that has failed, or has no key, can match nothing: it takes one of many lanes instead of
    meeting all others like it under one NULL key."""
    rows = source.withColumn(REASON, F.lit(None).cast("string"))
    for step in lookups:
        carried = [c for c in step.rows.columns if c != step.column]
        key = F.when(F.col(REASON).isNull(), F.col(step.key))
        lane = F.when(key.isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in source.columns]), F.lit(_LANES)) + 1).otherwise(F.lit(0))
        left = rows.withColumns({"_fs_key": key, _SPREAD: lane.cast("long")})
        # written so that it is not folded into a constant, which would drop the lane from the keys
        none = F.pmod(F.xxhash64(step.column), F.lit(1)).cast("long")
        right = step.rows.select(F.col(step.column).alias("_fs_right"), none.alias("_fs_lane"), *carried,
                                 F.lit(True).alias(_HIT)).filter("_fs_right IS NOT NULL").hint("merge")   # as in merge.not_matched
        found = left.join(right, (F.col("_fs_key") == F.col("_fs_right")) & (F.col(_SPREAD) == F.col("_fs_lane")), "left")
        rows = found.withColumn(REASON, F.coalesce(REASON, F.when(F.col(_HIT).isNull(), F.lit(step.reason)))).drop(
            "_fs_key", _SPREAD, "_fs_right", "_fs_lane", _HIT)
    return rows


def counts(entity: str, marked: DataFrame, passed: str = "migrated") -> DataFrame:
    """(Entity, Reason, SourceRows) of marked rows."""
    return marked.groupBy(F.coalesce(REASON, F.lit(passed)).alias(REASON)).agg(
        F.count(F.lit(1)).alias("SourceRows")).select(F.lit(entity).alias("Entity"), REASON, "SourceRows")
