import random
import re

import pytest

from forumshift.llm import substrings

SCHEMA = "doc_id long, text string"


def plain(rows, window):
    """{(doc_id, text): (words, removed, kept)}: every window looked up among all that start before it."""
    docs = sorted({(i is not None, i or 0, t) for i, t in rows}, key=lambda x: x[:2])
    seen, out = set(), {}
    for known, i, text in docs:
        ws = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
        gone = set()
        for s in range(len(ws) - window + 1):
            w = tuple(ws[s:s + window])
            if w in seen:
                gone.update(range(s, s + window))
            seen.add(w)
        out[i if known else None, text] = (len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone))
    return out


def found(spark, rows, window, parts=3):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = substrings.remove_repeats(docs, window).collect()
    assert len(got) == len(rows)
    return sorted(((x.doc_id, x.n_words, x.n_removed, x.kept) for x in got), key=repr)


def wanted(rows, window):
    known = plain(rows, window)
    return sorted(((i, *known[i, t]) for i, t in rows), key=repr)


def copied_rows(seed, window):
    """Texts made of fresh words, passages of a shared pool (whole, cut and changed) and periodic runs."""
    r = random.Random(seed)
    pool = [[f"p{k}w{j}" for j in range(r.randint(window, 3 * window))] for k in range(6)]
    rows = []
    for i in r.sample(range(1000), 50):
        ws = []
        for _ in range(r.randint(0, 6)):
            kind = r.random()
            if kind < 0.3:
                ws += [f"f{r.randrange(10 ** 6)}" for _ in range(r.randint(1, 2 * window))]
            elif kind < 0.8:
                p = list(r.choice(pool))
                a = r.randint(0, len(p) // 2)
                p = p[a:r.randint(a, len(p))] if r.random() < 0.5 else p
                if p and r.random() < 0.3:
                    p[r.randrange(len(p))] = "changed"
                ws += p
            else:
                ws += r.choice([["a"], ["a", "b"], ["x", "y", "z"]]) * r.randint(1, window)
        rows.append((i, "".join(w + r.choice([" ", " ", "\n", "\t", "  "]) for w in ws)))
    return rows


@pytest.mark.parametrize("seed,window", [(1, 20), (2, 5), (3, 9)])
def test_equals_looking_up_every_window(spark, seed, window):
    rows = copied_rows(seed, window)
    assert found(spark, rows, window) == wanted(rows, window)
    assert sum(x[1] for x in plain(rows, window).values()) > 50


def test_hot_anchors_small_shards_and_full_filters_change_nothing(spark, monkeypatch):
    """Every anchor is hot, every shard closes at once, every text is a chunk, every window is marked."""
    rows = copied_rows(4, 12) + [(2000 + k, " ".join(["u%d" % k] + ["common"] * 9 + ["v%d" % k] + ["w"] * 15)) for k in range(40)]
    monkeypatch.setattr(substrings, "HOT", 1)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 1)
    monkeypatch.setattr(substrings, "_CHUNK", 60)
    assert found(spark, rows, 12) == wanted(rows, 12)
    monkeypatch.setattr(substrings.Filter, "has", lambda self, h: h == h)
    assert found(spark, rows, 12) == wanted(rows, 12)


def test_equal_hashes_remove_nothing(spark, monkeypatch):
    """Words compare by their bytes: with one hash for all, only true repeats go."""
    monkeypatch.setattr(substrings, "mix", lambda x: x * substrings._U(0))
    rows = copied_rows(5, 8)[:25]
    assert found(spark, rows, 8) == wanted(rows, 8)


def test_nulls_blanks_repeats_case_and_clashing_columns(spark):
    p = " ".join(f"w{k}" for k in range(25))
    rows = [(5, p), (None, p), (7, p.upper()), (8, None), (9, ""), (10, " \n"), (11, "few words"), (5, p), (12, "x " * 30_000)]
    assert found(spark, rows, 20) == wanted(rows, 20)
    docs = spark.createDataFrame([(1, p, "a", 2), (2, p, "b", 3)], "doc_id long, text string, words string, tie long")
    assert sorted((x.doc_id, x.n_removed) for x in substrings.remove_repeats(docs).collect()) == [(1, 0), (2, 25)]
    assert substrings.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_automaton_knows_where_matches_ended_first():
    r = random.Random(9)
    texts = [[r.randrange(3) for _ in range(r.randint(0, 30))] for _ in range(12)]
    a = substrings.SuffixAutomaton()
    for k, t in enumerate(texts):
        a.add(t, k)
    for k, t in enumerate(texts):
        for window in (1, 3, 6):
            got = dict(a.repeats(t, window))
            for i in range(window, len(t) + 1):
                w = t[i - window:i]
                first = min((j, e) for j, u in enumerate(texts) for e in range(window, len(u) + 1) if u[e - window:e] == w)
                assert got[i] == first[0] << 32 | first[1]


def test_registered_query_equals_its_sql(spark, sf01):
    from oracle_check import compare
    assert compare(spark, sf01, ["op12_substrings"], verbose=False)["op12_substrings"]["match"]
