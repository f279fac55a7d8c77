"""What the registered queries add to their operators, on given tables, against plain versions; and
very long texts and clashing columns where the operators' own tests have none."""

import hashlib
import zlib

import numpy as np
import pytest

from forumshift.llm import chat, decontaminate, embeddings, licenses, lm_score, pii, queries
from tests.llm.helpers import benchmark_hits, personal_data
from tests.llm.test_tokens import library_ids


@pytest.fixture
def texts(spark, sf001):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text").collect()}


def test_op3_scores_words_and_their_mean(spark, sf001, texts):
    got = queries.op3_lm_score(spark, sf001).collect()
    assert {r.doc_id: r.n_words for r in got} == {k: len(t.split()) for k, t in texts.items()}
    for r in got:
        assert r.per_word == (r.log_likelihood / r.n_words if r.n_words else 0.0) and r.log_likelihood <= 0


def test_op5_pieces(spark, sf001, texts):
    got = queries.op5_packing(spark, sf001).collect()
    ids = dict(zip(texts, library_ids("word_bpe_49k.json", list(texts.values()), 2)))
    used = {}
    for p in got:
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes()) and p.doc_tokens == len(ids[p.doc_id])
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sum(p.length for p in got) == sum(map(len, ids.values()))
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096


def test_op9_counts_digest_and_spans(spark, sf001, texts):
    for r in queries.op9_pii(spark, sf001).collect():
        own = personal_data(texts[r.doc_id])
        order = ("email", "ip", "card", "phone")
        own.sort(key=lambda s: (order.index(s[0]), s[1]))
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in own) for k in order)
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))


def test_op10_reads_back_what_the_library_gives(spark, sf001, texts):
    ids = dict(zip(sorted(texts), library_ids("byte_bpe_50k.json", [texts[k] for k in sorted(texts)], 0)))
    start = dict(zip(ids, np.cumsum([0] + [len(x) for x in ids.values()])))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op10_token_store(spark, sf001).collect()}
    assert got == {k: (start[k], len(x), zlib.crc32(x.tobytes())) for k, x in ids.items()}


def test_very_long_texts(spark):
    """Texts of a million characters and more, of many and of one word."""
    filler = " ".join(f"w{k % 977}" for k in range(200_000))
    item = "one two three four five six seven eight nine ten eleven"
    long = f"{filler} {item} {filler} mail a@b.org or 10.0.0.1 {filler}"
    docs = spark.createDataFrame([(1, long), (2, "x" * 1_500_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    hit = {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.overlaps(docs, bench).collect()}
    words, places, _ = benchmark_hits(item, [(1, item)], 10)
    assert hit == {1: (600_000 + len(words) + 9, len(places)), 2: (1, 0)}
    spans = {r.doc_id: {(s["kind"], long[s["start"]:s["end"]]) for s in r.spans} for r in pii.find_spans(docs).collect()}
    assert {("email", "a@b.org"), ("ip", "10.0.0.1")} <= spans[1] and not spans[2]
    assert {r.doc_id: r.n_notices for r in licenses.scan(docs).collect()} == {1: 0, 2: 0}
    got = {r.doc_id: r.n_words for r in lm_score.score(docs).collect()}
    assert got == {1: 600_015, 2: 1}
    turns = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", "y" * 1_000_000)], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.examples(turns)).collect()
    assert len(back) == 1 and back[0].turns[0]["text"] == long and back[0].losses == ["y" * 1_000_000]


def test_clashing_columns_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b a", 5, "w", 2.0), (None, "a b a", 6, "w", 3.0)],
                                 "doc_id long, text string, n long, word string, log_likelihood double")
    got = {r.doc_id: (r.n_words, round(r.log_likelihood, 6)) for r in lm_score.score(docs).collect()}
    assert got[1] == got[None] and got[1][0] == 3
    vectors = spark.createDataFrame([(1, [1.0, 0.0], b"c", 1), (None, [1.0, 0.0], b"c", 2), (3, [0.0, 1.0], None, 3)],
                                    "vec_id long, embedding array<double>, cls binary, copies long")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(vectors).collect()}
    assert found == {1: (1, 1, True), None: (1, 1, False), 3: (0, 3, True)}
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    twice = docs.union(docs)
    assert sorted((r.doc_id or 0, r.n_hit) for r in decontaminate.overlaps(twice, bench, window=2).collect()) == [(0, 2), (0, 2), (1, 2), (1, 2)]
    redacted = pii.redact(spark.createDataFrame([(1, "a@b.org", "s"), (1, "a@b.org", "s")], "doc_id long, text string, spans string"))
    assert redacted.columns == ["doc_id", "text", "spans"] and redacted.count() == 2
