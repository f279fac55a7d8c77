"""Join helpers for shapes where a plain equi join would concentrate work in one task.

J8 "board-scoped products": several statements join tables only through ``BoardID`` after
both sides are restricted to one board, i.e. every row of the big side meets every row of
the small side under ONE key value.  J2 names and roles are skewed likewise.  A shuffle join
would send the rows of such a key to a single reducer.

``spread_join`` measures first: one pass counts the big side's rows by key (pre-aggregated, keys
only), and the keys with ``1/HEAVY_SHARE`` of the rows or more -- at most HEAVY_SHARE of them,
so their table is broadcast -- are spread over as many lanes as their share asks for.  Rows of
the other side are copied once per lane of their key; all other keys have one lane and no copies.

The result is exactly the plain inner join; nothing is dropped or capped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 1000
LEAST_ROWS = 1000              # a key of fewer rows is a small task wherever it is
_LANES, _LANE, _ROWS = "_fs_lanes", "_fs_lane", "_fs_rows"


def heavy_keys(df: DataFrame, on: Sequence[str], lanes: int | None = None) -> list[tuple]:
    """(*key, lanes) of the keys that hold 1/HEAVY_SHARE of the rows or more, and LEAST_ROWS; ``lanes``
    (by default the session's shuffle partitions) are dealt out by share.  NULL keys match nothing."""
    lanes = lanes or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias(_ROWS))
    for c in on:
        counts = counts.filter(F.col(c).isNotNull())
    # at most HEAVY_SHARE rows can pass the final test, and the largest are the ones that do
    top = counts.orderBy(F.desc(_ROWS)).limit(HEAVY_SHARE).collect()
    top = [r for r in top if r[_ROWS] >= LEAST_ROWS]
    if not top:
        return []
    total = df.count()
    return [(*[r[c] for c in on], max(2, -(-r[_ROWS] * lanes // total)))
            for r in top if r[_ROWS] * HEAVY_SHARE >= total]


def spread_join(big: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """``big`` JOIN ``small`` USING (on), heavy keys of ``big`` spread over lanes."""
    on = list(on)
    heavy = heavy_keys(big, on)
    if not heavy:
        return big.join(small, on)
    keys = big.select(*on).schema.add(_LANES, "long")
    table = F.broadcast(big.sparkSession.createDataFrame(heavy, keys))
    lane = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.coalesce(_LANES, F.lit(1)))
    many = big.join(table, on, "left").withColumn(_LANE, lane).drop(_LANES)
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(_LANES, F.lit(1).cast("long")) - 1))
    few = small.join(table, on, "left").withColumn(_LANE, copies).drop(_LANES)
    return many.join(few.hint("merge"), on + [_LANE]).drop(_LANE)     # the lanes are for a shuffle


def product_join(big: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """A join whose key has few values (J8): the same as ``spread_join``."""
    return spread_join(big, small, on)


def not_in(left: DataFrame, column: str, values: DataFrame, value_col: str | None = None) -> DataFrame:
    """SQL ``column NOT IN (SELECT value_col ...)`` at any size.

    Spark plans the null-aware anti join only as a broadcast; beyond the broadcast bound it
    falls back to a nested-loop join.  The SQL rules are applied explicitly instead, after
    one small aggregate over the list: an empty list keeps every row (NULL keys included),
    a NULL in the list keeps none, otherwise rows with a NULL key drop and the rest is an
    ordinary anti join, which Catalyst may broadcast or sort-merge.
    """
    value_col = value_col or column
    v = values.select(F.col(value_col).alias("_fs_v"))
    stats = v.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_fs_v").isNull(), 1)).alias("nulls")).first()
    if stats["n"] == 0:
        return left
    if stats["nulls"] > 0:
        return left.limit(0)
    return left.filter(F.col(column).isNotNull()).join(v.distinct(), F.col(column) == F.col("_fs_v"), "left_anti")
