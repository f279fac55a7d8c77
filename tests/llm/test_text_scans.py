"""Decontamination, personal data and licences."""

import random

import pytest

from forumshift.llm import decontaminate, licenses, pii
from tests.llm.helpers import benchmark_hits, personal_data


def hits(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string, n_hit string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontaminate.overlaps(d, b, **more).collect())


@pytest.mark.parametrize("group", [32_000_000, 60])
def test_automaton_matches_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(decontaminate, "GROUP_CHARS", group)
    r = random.Random(3)

    def text(n, known=3):
        return " ".join(r.choice("abc"[:known] + "X9é") for _ in range(n))

    items = [(k, text(r.choice([1, 2, 3, 4, 5, 8]))) for k in range(12)] + [(12, None), (13, "..."), (3, "a b a b a b")]
    docs = [(k, text(r.randint(0, 30), r.randint(1, 3)), "x") for k in range(60)] + [(60, None, None), (61, "", "")]
    want = []
    for k, t, _ in docs:
        ws, hit, found = benchmark_hits(t, [(i, x or "") for i, x in items], 4)
        want.append((k, len(ws), len(hit), sorted(found)))
    assert hits(spark, docs, items, window=4) == want


def test_no_benchmark_and_no_documents(spark):
    assert hits(spark, [(1, "a b", "")], [], window=2) == [(1, 2, 0, [])]
    assert hits(spark, [], [(1, "a b")], window=2) == []


def test_cleaning_cuts_spans_and_drops_copies(spark):
    docs = spark.createDataFrame([(1, "Keep this. One, two THREE four! And this.", "s", 41), (2, "one two three four", "s", 18),
                                  (3, None, None, None), (4, "two three", "s", 9)],
                                 "doc_id long, text string, spans string, n_chars long")
    items = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    got = decontaminate.decontaminate(docs, items, window=3, max_match=3)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [(1, "Keep this. ! And this.", "s", 22), (3, None, None, None),
                                                       (4, "two three", "s", 9)]


@pytest.mark.parametrize("group", [32_000_000, 20])
def test_adjacent_and_repeated_short_items_are_cut(spark, monkeypatch, group):
    monkeypatch.setattr(decontaminate, "GROUP_CHARS", group)
    one, two = "who wrote the old red book", "where does this river meet another"
    tail = " and nothing else of note" * 4
    docs = spark.createDataFrame([(1, f"{one} {two}{tail}"), (2, f"{one} {one} {one}{tail}"), (3, one + tail),
                                  (4, f"{one} {two}"), (5, "who wrote the old" + tail)], "doc_id long, text string")
    items = spark.createDataFrame([(1, one), (2, two)], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == {1: tail, 2: tail, 3: tail, 5: "who wrote the old" + tail}


def test_anchors_match_patterns():
    r, finder = random.Random(1), pii.Finder()
    pools = ["a@.-+", "0123456789", "0123456789 .-", "+ ()", "a1b.c@d.e", "1.2.", "é\n "]
    for _ in range(20_000):
        text = "".join(r.choice(r.choice(pools)) for _ in range(r.randint(0, 60)))
        found = finder.find(text)
        assert [(k, *s) for k in ("email", "ip", "card", "phone") for s in found[k]] == personal_data(text), text


def test_added_kinds_and_redaction(spark):
    text = ("Mail a.b@c.org, see https://x.org/a?b=1. IBAN: DE89 3704 0044 0532 0130 00 ok; account no 123456789. "
            "password=hunter22 10.0.0.1 +1 (555) 123-4567; 4111 1111 1111 1111")
    docs = spark.createDataFrame([(1, text, 0, "a"), (2, None, 5, "b"), (3, "", 0, "c")],
                                 "doc_id long, text string, n_chars long, kind string")
    got = {r.doc_id: [(s.kind, text[s.start:s.end]) for s in r.spans] for r in pii.find_spans(docs).collect()}
    assert got == {1: [("email", "a.b@c.org"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 123-4567"),
                       ("url", "https://x.org/a?b=1"), ("account", "DE89 3704 0044 0532 0130 00"), ("account", "123456789"),
                       ("secret", "hunter22")], 2: [], 3: []}
    clean = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert clean[1].text == ("Mail <EMAIL>, see <URL>. IBAN: <ACCOUNT> ok; account no <ACCOUNT>. password=<SECRET> <IP> "
                             "<PHONE>; <CARD>")
    assert clean[1].n_chars == len(clean[1].text) and clean[2].text is None and clean[3].text == ""
    assert pii.find_spans(docs.limit(0)).count() == 0 and pii.redact(docs.limit(0)).count() == 0


def test_licences(spark):
    mit = next(t for k, t in licenses.KNOWN if k == "MIT" and t.startswith("Permission"))
    odd = "Copyright (c) 2020 A. Body\n\n" + mit.replace(",", " ,").replace("\n", " \n").upper().replace("SUBLICENSE", "SUBLICENCE")
    docs = spark.createDataFrame([(1, odd, "x"), (2, "Some text\nReleased under the MIT licence\nmore", "y"), (3, None, "z"),
                                  (4, "", "z"), (4, "licensed under CC BY-NC 4.0", "z"), (5, "MIT License", "k"),
                                  (None, "Licensed under the Apache License, version 2.0", "n")],
                                 "doc_id long, text string, digest string")
    got = sorted(((r.doc_id or 0, r.whole_text, r.licenses, r.n_notices) for r in licenses.scan(docs).collect()), key=str)
    assert got == [(0, "Apache-2.0", "Apache-2.0", 1), (1, "MIT", "MIT", 0), (2, None, "MIT", 1), (3, None, "", 0),
                   (4, "CC-BY-NC-4.0", "CC-BY-NC-4.0", 1), (4, "CC-BY-NC-4.0", "CC-BY-NC-4.0", 1), (5, None, "", 0)]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_entire_texts_of_common_licences(spark):
    texts = [(k, t) for k, t in licenses.KNOWN if t.count("\n") > 3]
    docs = spark.createDataFrame([(n, f"Copyright (c) 2021, A. Body\n\n{t}") for n, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.whole_text for r in licenses.scan(docs).collect()}
    assert got == {n: k for n, (k, _) in enumerate(texts)}
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0"} <= set(got.values())
