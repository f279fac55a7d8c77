import math
import random

import pytest

from forumshift.llm import minhash
from forumshift.llm.components import components
from tests.llm.helpers import labels, near_components

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("width", [2, 5])
def test_given_documents_match_brute_force(spark, sf001, width):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, width=width).collect()}
    assert got == near_components([(r.doc_id, r.text) for r in docs.collect()], width)


def test_families_that_a_star_cannot_join(spark, monkeypatch):
    """Chains and noisy families: most links are not with a bucket's centre; blocks are tiny."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    r = random.Random(4)
    docs = []
    for family in range(3):
        words = [f"w{family}x{k}" for k in range(60)]
        for step in range(14):                       # a chain: each text is near its neighbours only
            docs.append((len(docs), " ".join(words)))
            words[(step * 4) % 60], words[(step * 4 + 1) % 60] = f"n{r.random()}", f"m{r.random()}"
        for _ in range(20):                          # a cloud around one text
            own = list(words)
            for k in r.sample(range(60), r.randint(0, 6)):
                own[k] = f"o{r.random()}"
            docs.append((len(docs), " ".join(own)))
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(spark.createDataFrame(docs, SCHEMA), width=2).collect()}
    assert got == {k: c for k, (_, c) in near_components(docs, 2).items()}


def test_nulls_blanks_repeats_and_clashing_columns(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, "A  b\tC", "y"), (3, None, None), (4, " \n", "z"), (4, "", "z"),
            (5, "one", "k"), (6, "one", "k"), (None, "a b c", "n"), (None, "only here now", "n"), (7, "b " * 50_000, "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cls string").withColumnRenamed("cls", "root")
    got = sorted((x.doc_id is None, x.doc_id or 0, x.n_shingles, x.component_id, x.kept)
                 for x in minhash.near_duplicates(docs, width=2).collect() if x.n_shingles != 2 or x.doc_id is not None)
    assert got == [(False, 1, 2, 1, True), (False, 1, 2, 1, True), (False, 2, 2, 1, False), (False, 3, 0, 3, True),
                   (False, 4, 0, 4, True), (False, 4, 0, 4, True), (False, 5, 1, 5, True), (False, 6, 1, 5, False),
                   (False, 7, 1, 7, True)]
    kept = minhash.keep_first(docs, width=2)
    assert kept.columns == docs.columns
    assert sorted((x.doc_id or 0, x.text or "") for x in kept.select("doc_id", "text").collect()) == [
        (0, "only here now"), (1, "a b c"), (3, ""), (4, ""), (4, " \n"), (5, "one"), (7, "b " * 50_000)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.keep_first(empty).count() == 0


def test_components_of_chains_and_hubs(spark):
    r = random.Random(2)
    links = [(k, k + 1) for k in range(200)] + [(300, 300 + k) for k in range(1, 150)]
    links += [(r.randrange(500, 900), r.randrange(500, 900)) for _ in range(300)]
    edges = spark.createDataFrame(links + [(None, 3), (7, 7)], "u long, v long").repartition(7)
    got = {x.node: x.root for x in components(edges, "test").collect()}
    low = labels(1000, links)
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert {k: got.get(k, k) for k in touched} == {k: low[k] for k in touched}


def test_sketches_lose_far_less_than_bands():
    bits, most = 2 * minhash.PERMUTATIONS, minhash._most_differing(80)
    lost = sum(math.comb(bits, k) * 0.1 ** k * 0.9 ** (bits - k) for k in range(most + 1, bits + 1))
    assert lost < (1 - 0.8 ** minhash.ROWS) ** minhash.BANDS / 1000


def test_hubs_take_lanes(spark, monkeypatch):
    """Nodes with most of the links are found while the links are written, and change nothing."""
    from forumshift.llm import components as c
    monkeypatch.setattr(c, "HUB_LINKS", 20)
    monkeypatch.setattr(c, "HUB_SHARE", 8)
    r = random.Random(6)
    links = [(1, k) for k in range(2, 400)] + [(k, 5000) for k in range(300, 700)] + [(800 + k, 801 + k) for k in range(30)]
    links += [(r.randrange(900, 999), r.randrange(900, 999)) for _ in range(50)]
    edges = spark.createDataFrame(links, "u long, v long").repartition(9)
    _, mark, hubs = c._staged(edges, "test")
    assert mark[0] == len(links)
    assert set(hubs) == {x[0] for x in spark.createDataFrame([(1,), (5000,)], "u long").selectExpr("xxhash64(u)").collect()}
    got = {x.node: x.root for x in components(edges, "test").collect()}
    low = labels(6000, links)
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert {k: got.get(k, k) for k in touched} == {k: low[k] for k in touched}
