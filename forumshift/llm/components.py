"""Connected components over an edge table, with DataFrame joins only.

Alternating large-star and small-star rounds: every round is one aggregation (a minimum per
node, combined before the shuffle) and one join back.  The nodes with a large share of the links
are found by a sketch while the links are written; their links take one of LANES lanes in the
join, and their one minimum is copied to all lanes, so a node with millions of neighbours is
never gathered in one task.  Each partition first replaces its edges by a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from forumshift.llm.shipping import arrow_map
from forumshift.llm.staging import stage
from forumshift.operators.joins import spread_join

LANES, HUB_SHARE, HUB_LINKS = 64, 200, 500     # a hub has 1/HUB_SHARE of the links, and HUB_LINKS at least


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict = {}

    def find(x):
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    schema = None
    for b in batches:
        schema = b.schema
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            a, c = find(u), find(v)
            if a != c:
                parent[max(a, c)] = min(a, c)
    if schema is not None:
        nodes = [x for x in parent if find(x) != x]
        step = 100_000
        for i in range(0, len(nodes), step):
            part = nodes[i:i + step]
            yield pa.RecordBatch.from_arrays([pa.array(part, schema.field(0).type),
                                              pa.array([find(x) for x in part], schema.field(1).type)],
                                             schema=schema)


def star(one: np.ndarray, two: np.ndarray, n: int) -> np.ndarray:
    """Least reachable index of each of n nodes under the links (one[k], two[k]), in memory."""
    low = np.arange(n)
    while len(one):
        least = np.minimum(low[one], low[two])
        was = low.copy()
        np.minimum.at(low, one, least)
        np.minimum.at(low, two, least)
        low = low[low]
        if (low == was).all():
            break
    return low


def name_components(classes: DataFrame, roots: DataFrame, id_col: str) -> DataFrame:
    """(cls, component_id): the least id of each class's component."""
    named = classes.select("cls", id_col).join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
    named = stage(named.withColumn("root", F.coalesce("root", "cls")), "component-roots")
    least = named.groupBy("root").agg(F.min(id_col).alias("component_id"))
    return spread_join(named.select("cls", "root"), least, ["root"]).select("cls", "component_id")


def _star(edges: DataFrame, large: bool, hubs: list[int]) -> DataFrame:
    """Large: neighbours above a node hang on its minimum; small: those below it do."""
    if large:
        around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = around.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    if hubs:
        hub, lanes = F.xxhash64("u").isin(hubs), F.lit(LANES).cast("long")
        around = around.withColumn("lane", F.when(hub, F.pmod(F.xxhash64("v"), lanes)).otherwise(F.lit(0)))
        copies = low.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.when(hub, lanes - 1).otherwise(F.lit(0)))))
        hung = around.join(copies, ["u", "lane"]).drop("lane")
    else:
        hung = around.join(low, "u")
    if large:
        hung = hung.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        hung = hung.select(F.col("v").alias("u"), F.col("low").alias("v")).union(
            low.select("u", F.col("low").alias("v")))
    return hung.filter(F.col("u") != F.col("v")).distinct()


def _staged(edges: DataFrame, label: str) -> tuple[DataFrame, tuple, list[int]]:
    """The edges written and reread, with their number, a checksum and the hashes of the hubs (HUB_SHARE
    of either column at most), all taken while writing."""
    seen = Observation()
    sums = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
    tops = [F.expr(f"approx_top_k(xxhash64({c}), {HUB_SHARE}, {4 * HUB_SHARE})").alias(f"top_{c}") for c in "uv"]
    out = stage(edges.observe(seen, F.count(F.lit(1)).alias("n"), sums, *tops), f"{label}-edges")
    got = seen.get
    degree: dict[int, int] = {}
    for c in "uv":
        for item, count in got.get(f"top_{c}") or ():
            degree[item] = degree.get(item, 0) + count
    least = max(HUB_LINKS, (got.get("n") or 0) // HUB_SHARE)
    return out, (got.get("n"), got.get("sum")), sorted(h for h, n in degree.items() if n >= least)


def _round(edges: DataFrame, hubs: list[int], label: str) -> tuple[DataFrame, tuple, list[int]]:
    # only edges are read here: as many files as the cluster can use at once are enough
    few = 4 * edges.sparkSession.sparkContext.defaultParallelism
    # a node has no more links in the large star's result than in its input
    return _staged(_star(_star(edges, True, hubs), False, hubs).coalesce(few), label)


def _first_round(edges: DataFrame, label: str) -> tuple[DataFrame, tuple, list[int]]:
    edges = edges.select("u", "v").filter("u IS NOT NULL AND v IS NOT NULL AND u != v").distinct()
    forest, _, hubs = _staged(arrow_map(edges, _forest, edges.schema), label)
    return _round(forest, hubs, label)


def hang(edges: DataFrame, label: str) -> DataFrame:
    """One round: edges (u, v) from each linked node to a lower node of its component.  Not yet
    the least one everywhere, but equal v always means one component."""
    return _first_round(edges, label)[0]


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v); root is the least node reachable.

    Nulls and self-links are ignored; repeated links do not matter; an empty table gives an
    empty result.
    """
    edges, mark, hubs = _first_round(edges, label)
    while True:
        edges, now, hubs = _round(edges, hubs, label)
        if now == mark:                      # a round that changes nothing has found all roots
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
