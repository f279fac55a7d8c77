"""Parent links by pointer doubling."""

import random

import pytest
from pyspark.sql import functions as F

from forumshift.operators import joins
from forumshift.operators.tree import resolve


def found(spark, rows, stage=lambda df: df.checkpoint(eager=True)):
    df = spark.createDataFrame(rows, "id long, parent long")
    t = resolve(df, "id", "parent", F.col("parent") == 0, stage)
    return ({(r.id, r.root, r.level) for r in t.nodes.collect()}, {(r.id, r.root, r.level) for r in t.orphans.collect()},
            {r.id for r in t.cyclic.collect()}, t.rounds)


def plain(rows):
    parent = dict(rows)
    nodes, orphans, cyclic = set(), set(), set()
    for i in parent:
        x, level, seen = i, 0, {i}
        while parent[x] != 0 and parent[x] in parent:
            x, level = parent[x], level + 1
            if x in seen:
                cyclic.add(i)
                break
            seen.add(x)
        else:
            (nodes if parent[x] == 0 else orphans).add((i, x, level))
    return nodes, orphans, cyclic


def test_chain_of_two_thousand_in_few_rounds(spark):
    rows = [(k, k - 1) for k in range(1, 2001)]
    random.Random(1).shuffle(rows)
    nodes, orphans, cyclic, rounds = found(spark, rows)
    assert nodes == {(k, 1, k - 1) for k in range(1, 2001)} and not orphans and not cyclic and rounds <= 12


@pytest.mark.parametrize("seed", [3, 4])
def test_random_links_with_orphans_and_cycles(spark, seed):
    r = random.Random(seed)
    ids = r.sample(range(1, 400), 120)
    rows = [(i, r.choice([0, 0, None, 999, i, *r.sample(ids, 4)])) for i in ids]
    nodes, orphans, cyclic, _ = found(spark, rows)
    want = plain([(i, p) for i, p in rows])
    assert (nodes, orphans, cyclic) == want


def test_one_parent_of_nearly_all(spark, monkeypatch):
    """A hot parent is spread over lanes; the result is the same."""
    monkeypatch.setattr(joins, "LEAST_ROWS", 5)
    rows = [(1, 0), (2, 1)] + [(k, 2) for k in range(3, 300)] + [(1000, 5), (1001, 1000)]
    nodes, orphans, cyclic, rounds = found(spark, rows)
    assert (nodes, orphans, cyclic) == plain(rows) and rounds <= 4


def test_empty_and_roots_alone(spark):
    assert found(spark, []) == (set(), set(), set(), 0)
    assert found(spark, [(4, 0), (5, 0)]) == ({(4, 4, 0), (5, 5, 0)}, set(), set(), 0)
