"""Parent links resolved by pointer doubling.

Every row points to its parent; in a round each open row takes over where its target points, so
the distance covered doubles and a tree of depth d needs about log2(d) rounds, whatever its shape.
A round is one join of the open rows with all rows, staged; rows that have reached a top are done.
Rows that are still open after log2(n) + 1 rounds are on, or below, a cycle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .joins import spread_join


@dataclass
class Tree:
    nodes: DataFrame      # id, root, level (0 at the root): rows whose top is a root
    orphans: DataFrame    # the same for rows whose top hangs below a parent that does not exist
    cyclic: DataFrame     # id of the rows whose parents never end
    rounds: int


def resolve(rows: DataFrame, id_col: str, parent_col: str, is_root: Column,
            stage: Callable[[DataFrame], DataFrame]) -> Tree:
    """Level and root of every row.  Ids are unique; ``is_root`` tells roots; a row that is neither a root
    nor has an existing parent is the top of orphans."""
    rows = rows.select(F.col(id_col).alias("id"), F.col(parent_col).alias("up"), is_root.alias("top"))
    there = rows.select(F.col("id").alias("up"), F.lit(True).alias("there"))
    start = rows.join(there, "up", "left").select(
        "id", F.coalesce("top", F.lit(False)).alias("rooted"), F.coalesce(F.col("there") & ~F.coalesce("top", F.lit(False)),
                                                                           F.lit(False)).alias("open"), "up")
    start = start.select("id", "rooted", F.when(F.col("open"), F.col("up")).alias("jump"),
                         F.when(F.col("open"), F.col("up")).otherwise(F.col("id")).alias("root"),
                         F.col("open").cast("long").alias("level"))
    current, left = _counted(start, stage)
    done, rounds, total = current.filter("jump IS NULL"), 0, None
    while left:
        total = total if total is not None else rows.count()
        if 2 ** rounds > total:
            break
        rounds += 1
        target = current.select(F.col("id").alias("jump"), F.col("rooted").alias("t_rooted"), F.col("jump").alias("t_jump"),
                                F.col("root").alias("t_root"), F.col("level").alias("t_level"))
        stepped = spread_join(current.filter("jump IS NOT NULL").select("id", "jump", "level"), target, ["jump"]).select(
            "id", F.col("t_rooted").alias("rooted"), F.col("t_jump").alias("jump"), F.col("t_root").alias("root"),
            (F.col("level") + F.col("t_level")).alias("level"))
        now, left = _counted(stepped, stage)
        done = done.unionByName(now.filter("jump IS NULL"))
        current = done.unionByName(now.filter("jump IS NOT NULL")) if left else done
    nodes = done.select("id", "root", "level")
    return Tree(done.filter("rooted").select(nodes.columns), done.filter("NOT rooted").select(nodes.columns),
                current.filter("jump IS NOT NULL").select("id"), rounds)


def _counted(rows: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, int]:
    seen = Observation()
    out = stage(rows.observe(seen, F.count("jump").alias("open")))
    return out, seen.get["open"]
