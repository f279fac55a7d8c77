"""D6 surrogate keys.

``assign_ids`` gives every row a new id ``base + rank``, where ``rank`` is the row's 1-based
position in ``order_by`` order -- exactly ``base + row_number() OVER (ORDER BY ...)`` -- without
the single-partition window that SQL form implies:

1. range-shuffle the rows on the order columns and sort inside each partition (the number of
   partitions is the session's, which AQE coalesces to the measured bytes; neighbouring ranges
   stay in order),
2. stage the sorted rows once with their partition and their place in it -- range bounds are
   sampled and must not be drawn again between counting and numbering,
3. count rows per partition and turn the counts into running offsets, a table with one row per
   partition that is joined back,
4. id = base + offset(partition) + place inside the partition.

The place comes from ``monotonically_increasing_id`` evaluated right after the sort in the same
task, so no second shuffle is needed.  The order columns must be unique for ids to be
reproducible; callers pass a tiebreaker column.  Callers number narrow rows and attach payload
columns afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

_PART = "_fs_part"
_POS = "_fs_pos"
_OFF = "_fs_off"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def max_id_value(df: DataFrame, id_col: str) -> int:
    """Largest existing id, resolved now (one small job over the id column only)."""
    return int(df.select(F.max(F.col(id_col)).cast("bigint")).first()[0] or 0)


def checkpoint_stage(df: DataFrame) -> DataFrame:
    """Default stage: a reliable checkpoint in ``spark.checkpoint.dir`` (never a local one)."""
    return df.checkpoint(eager=True)


@dataclass
class Numbered:
    df: DataFrame     # rows with their new id
    count: int        # number of rows numbered (so the caller knows the new max id)


def number_rows(df: DataFrame, id_col: str, order_by: Sequence[Column | str], base: Column | int = 0,
                num_partitions: int | None = None,
                stage: Callable[[DataFrame], DataFrame] | None = None) -> Numbered:
    keys = [_as_col(c) for c in order_by]
    base_col = base if isinstance(base, Column) else F.lit(int(base))
    stage = stage or checkpoint_stage
    parted = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    seen = Observation()
    ranged = parted.sortWithinPartitions(*keys).withColumn(_PART, F.spark_partition_id()).withColumn(_POS, place)
    fixed = stage(ranged.observe(seen, F.count(F.lit(1)).alias("n")))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)     # one row per partition
    counts = fixed.groupBy(_PART).agg(F.count(F.lit(1)).alias("_fs_n"))
    offsets = counts.withColumn(_OFF, F.coalesce(F.sum("_fs_n").over(before), F.lit(0)))
    # an inner join: a partition without an offset would lose its rows, not reuse ids
    new_id = (base_col.cast("bigint") + F.col(_OFF) + F.col(_POS) + F.lit(1)).cast("bigint")
    out = fixed.join(F.broadcast(offsets.select(_PART, _OFF)), _PART).withColumn(id_col, new_id)
    return Numbered(out.drop(_PART, _POS, _OFF), int(seen.get["n"]))


def assign_ids(df: DataFrame, id_col: str, order_by: Sequence[Column | str],
               base: Column | int = 0, num_partitions: int | None = None,
               stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    return number_rows(df, id_col, order_by, base, num_partitions, stage).df
