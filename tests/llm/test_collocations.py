import random
import re
from collections import Counter

import pytest

from forumshift.llm import bloom, collocations
from tests.llm.helpers import fold

SCHEMA = "lang string, text string"


def plain(rows, least, longest, percent, top):
    """The ranked phrases from all phrases, counted one by one."""
    f, sizes = Counter(), Counter()
    for lang, text in ((x if x is not None else "und", t) for x, t in rows):
        for piece in re.split("[.,;:!?\x0a-\x0d]", fold(text)):
            ws = [w for w in re.split("[\x20\x09]+", piece) if w]
            sizes[lang] += len(ws)
            f.update((lang, tuple(ws[i:i + k])) for k in range(1, longest + 1) for i in range(len(ws) - k + 1))
    f = {k: a for k, a in f.items() if a >= least}
    out = {}
    for (lang, ws), a in f.items():
        if len(ws) < 2 or any(x == lang and len(v) > len(ws) and 100 * b >= percent * a and
                              any(v[i:i + len(ws)] == ws for i in range(len(v))) for (x, v), b in f.items()):
            continue
        cuts = [(1000 * a * sizes[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return {(lang, rank, p.decode(), -a, le, r, sizes[lang], -s)
            for lang, xs in out.items() for rank, (s, a, p, le, r) in enumerate(sorted(xs)[:top], 1)}


def found(spark, rows, **args):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    args = {"min_count": 4, "longest": 5, "percent": 100, "top": 50} | args
    return {tuple(r) for r in collocations.collocations(docs, **args).collect()}, plain(
        rows, args["min_count"], args["longest"], args["percent"], args["top"])


def random_rows(seed):
    r = random.Random(seed)
    words = ["a", "B", "b", "é", "É", "long-word", "x1", "<|y|>", " ", "日本", "á", "."]
    return [(r.choice(["en", "en", "en", "fr", None, "und", ""]),
             "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ", ", "\n"]) for _ in range(r.randint(0, 60))))
            for _ in range(120)]


@pytest.mark.parametrize("percent", [100, 60])
def test_equals_counting_every_phrase(spark, percent):
    got, want = found(spark, random_rows(7), percent=percent)
    assert got == want and len(got) > 60


def test_small_filters_chunks_and_hot_prefixes_change_nothing(spark, monkeypatch):
    """A full filter lets everything through; every prefix is hot; every text is a chunk."""
    rows = random_rows(8) + [("en", "the end of the " * 400)]
    monkeypatch.setattr(bloom, "FILTER_BITS", 1 << 16)
    monkeypatch.setattr(collocations, "HEAVY", 10 ** 9)
    monkeypatch.setattr(collocations, "_CHUNK", 40)
    monkeypatch.setattr(collocations.Filter, "has", lambda self, h: h == h)
    got, want = found(spark, rows, min_count=5)
    assert got == want


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """With all hashes in eight values, the words themselves still decide."""
    few = collocations.mix
    monkeypatch.setattr(collocations, "mix", lambda x: few(x) % collocations._U(8))
    import numpy as np
    a, b = np.array([1, 1, 2, 2, 1]), np.array([5, 6, 5, 5, 5])
    order, first = collocations._groups(np.zeros(5, np.uint64), [a, b])
    groups = [set(map(int, order[i:j])) for i, j in zip(first, list(first[1:]) + [5])]
    assert sorted(map(sorted, groups)) == [[0, 4], [1], [2, 3]]


def test_nulls_blanks_repeats_and_no_phrases(spark):
    rows = [(None, None), ("en", ""), ("en", " \n.,"), ("en", "one two")] + [("fr", "un deux, trois")] * 9
    got, want = found(spark, rows)
    assert got == want == {("fr", 1, "un deux", 9, 9, 9, 27, 3000)}
    assert found(spark, rows, min_count=100)[0] == set()
    empty = spark.createDataFrame([], "rank int, text string, lang string, n int, phrase int")
    assert collocations.collocations(empty).count() == 0
    clash = spark.createDataFrame([("x y", "en", 1, "p", 2)] * 5, "text string, lang string, n int, phrase string, slot int")
    assert [tuple(x) for x in collocations.collocations(clash, min_count=5).collect()] == [("en", 1, "x y", 5, 5, 5, 10, 2000)]


def test_products_beyond_64_bits(spark):
    """1000 * a * n and l * r far beyond 64 bits, in the scoring alone."""
    big = 3 * 10 ** 12
    phrases = spark.createDataFrame([("en", "p q", big, [2 * big, big], [big + 1], 2)],
                                    "lang string, phrase string, a long, lefts array<long>, rights array<long>, k int")
    sizes = spark.createDataFrame([("en", 10 ** 13)], "lang string, n long")
    row = collocations._ranked(phrases, sizes, 100, 5).collect()[0]
    assert row.score == 1000 * big * 10 ** 13 // (2 * big * (big + 1))


def test_texts_are_read_twice_and_stripes_travel_in_few_rows(spark, monkeypatch):
    """Levels read numbered words, not the texts again; a task sends a row, not one for each prefix, to a place."""
    made, real = [], collocations.arrow_map

    def seen(df, run, schema):
        made.append((df, real(df, run, schema)))
        return made[-1][1]
    monkeypatch.setattr(collocations, "arrow_map", seen)
    r = random.Random(3)
    rows = [("en", " ".join(f"w{r.randrange(60)}" for _ in range(300))) for _ in range(30)]
    got, want = found(spark, rows, min_count=3, longest=3)
    assert got == want and len(got) == 50
    assert sum("text" in df.columns for df, _ in made) == 2
    places = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = [out.count() for df, out in made if "text" not in df.columns and "binary" in dict(out.dtypes).values()]
    assert len(sent) == 2 and max(sent) <= 3 * places


@pytest.mark.parametrize("numbered", [3, 12])
def test_words_without_a_number_count_the_same(spark, monkeypatch, numbered):
    monkeypatch.setattr(collocations, "VOCAB", numbered)
    rows = random_rows(9) + [("x. y 1", "A a a a, b a. a a a b b"), ("", "a b a b a b a b a b")]
    got, want = found(spark, rows)
    assert got == want and len(got) > 60


def test_small_shares_of_a_level_change_nothing(monkeypatch):
    """Tasks that send and merge a few places at a time; some words have numbers, of others' hashes."""
    import numpy as np
    import pyarrow as pa
    for name, least in (("_CHUNK", 60), ("_PLACES", 50), ("_CODES", 7), ("_MERGE", 9)):
        monkeypatch.setattr(collocations, name, least)
    rows = [(x if x is not None else "und", t) for x, t in random_rows(10)]
    texts = [pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows[i:i + 50])], ["lang", "text"]) for i in range(0, 120, 50)]
    names = pa.concat_arrays([collocations._named(x, pa.array(["a", "é", "x1", "b"])) for x in ("fr", "en", "")])
    vocab = collocations.Vocabulary(names)
    every = collocations.Filter(1 << 16, b"\xff" * (1 << 13))
    hot = collocations._hashes(pa.array(["en"] * 2), pa.array(["a", "b"]), 1)
    none = collocations.Vocabulary(names.slice(0, 0))

    def merged(sent, k, vocab):
        sent = sorted((tuple(r.values()) for b in sent for r in b.to_pylist()), key=lambda r: r[:2])
        for part in sorted({r[0] for r in sent}):
            mine = [r for r in sent if r[0] == part]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*mine), collocations._BUNDLE_ARROW.types)],
                                               schema=collocations._BUNDLE_ARROW)
            yield from (r for b in collocations._merge(iter([batch]), k, 1, vocab) for r in b.to_pylist())

    coded = list(collocations._sent(collocations._coded(iter(texts), vocab, every), collocations._CODED_ARROW))
    assert sum(b.num_rows for b in coded) > 100
    for k in (1, 2, 3, 4):
        want, got, total = Counter(), Counter(), Counter()
        for lang, text in rows:
            for piece in re.split("[.,;:!?\x0a-\x0d]", fold(text)):
                ws = [w for w in re.split("[\x20\x09]+", piece) if w]
                want.update((lang, tuple(ws[i:i + k])) for i in range(len(ws) - k + 1))
        of = none if k == 1 else vocab
        sent = collocations._word_stripes(iter(texts), 3, 2) if k == 1 else collocations._phrase_stripes(iter(coded), k, vocab, every, hot, 3, 2)
        for r in merged(collocations._sent(sent, collocations._BUNDLE_ARROW), k, of):
            for w, n in zip(r["next"], r["n"]):
                (got if w is not None else total)[r["lang"], tuple(f"{r['prefix']} {w or ''}".split(" ")[k == 1:])] += n
        assert got == want
        assert k > 1 or {x: n for (x, _), n in total.items()} == {x: sum(n for (y, _), n in want.items() if x == y) for x, _ in want}


def test_registered_query_equals_its_sql(spark, sf01):
    from oracle_check import compare
    assert compare(spark, sf01, ["op11_collocations"], verbose=False)["op11_collocations"]["match"]
