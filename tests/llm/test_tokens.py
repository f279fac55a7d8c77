"""Tokenisation, packing and the token store."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from forumshift.llm import packing, token_store
from forumshift.llm.queries import vocabulary
from forumshift.llm.tokens import Encoder
from forumshift.llm.tokens import vocabulary as read_vocabulary

PIECES = ["a", "b", "é", " ", "  ", "\n", "\t", " ", " ", "\x85", "\x1c", "'s", "1", "23", "Σ", "ΑΣ", ".", "!",
          "́", "e", "<|endoftext|>", "word", "the", "\r\n", "\x00", "İ", "​", "中", "😀"]
DOCS = "doc_id long, text string, start string"


def library_ids(name, texts, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(name))
    t.encode_special_tokens = True
    return [np.array([*e.ids, end], "<u4") for e in t.encode_batch(texts, add_special_tokens=False)]


def some_texts(n, seed, most=30):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_give_the_library_ids(name, monkeypatch):
    from forumshift.llm import tokens
    monkeypatch.setattr(tokens, "TABLE_WORDS", 3000)       # the table starts anew several times
    monkeypatch.setattr(tokens, "BATCH_BYTES", 4000)
    texts = some_texts(4000, 5)
    enc = Encoder(read_vocabulary(vocabulary(name)), 0)
    got = list(enc.encode(pa.array([None, *texts])))[1:]
    want = library_ids(name, texts, 0)
    assert [np.frombuffer(x, enc.dtype).tolist() for x in got] == [x.tolist() for x in want]


def test_nnls():
    a = np.random.default_rng(1).random((8, 20))
    b = a @ np.maximum(0, np.random.default_rng(2).normal(size=20))
    x = packing.nnls(a, b)
    assert (x >= 0).all() and np.allclose(a @ x, b, atol=1e-6)
    c = packing.combinations(64, 4)
    assert ((np.arange(1, 65) @ c) == 64).all() and c.sum(0).max() == 4


@pytest.mark.parametrize("block", [6_000_000, 900])
def test_every_id_is_packed_once(spark, monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", block)
    r = random.Random(8)
    texts = some_texts(300, 9, 80) + [" ".join(r.choice(["the", "word", "anouan"]) for _ in range(900)), "", ""]
    docs = [(k, t, "x") for k, t in enumerate(texts)] + [(None, None, None)]
    got = packing.pack(spark.createDataFrame(docs, DOCS).repartition(3), vocabulary("word_bpe_49k.json"), 2, window=128).collect()
    ids = dict(zip([d[0] for d in docs], library_ids("word_bpe_49k.json", [d[1] or "" for d in docs], 2)))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in got:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        part = ids[p.doc_id][p.start:p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(part.tobytes()) and np.frombuffer(p["ids"], "<u2").tolist() == part.tolist()
    assert set(by_doc) == set(ids)
    for k, ps in by_doc.items():
        ps.sort(key=lambda p: p.start)
        assert [p.start for p in ps] == np.cumsum([0] + [p.length for p in ps])[:-1].tolist()
        assert sum(p.length for p in ps) == len(ids[k]) == ps[0].doc_tokens
    for ps in by_sequence.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == np.cumsum([0] + [p.length for p in ps])[:-1].tolist()
        total = sum(p.length for p in ps)
        assert total == 128 or total < 128 and total & (total - 1) == 0
    assert packing.pack(spark.createDataFrame([], DOCS), vocabulary("word_bpe_49k.json"), 2).count() == 0


def test_perfect_hash():
    h = token_store.key_hash(np.arange(5000) * 7 - 900, np.zeros(5000, bool), np.zeros(5000))
    mph = token_store.MinimalPerfectHash.build(h)
    assert sorted(mph.slots(h).tolist()) == list(range(5000))


def test_store_round_trip(spark):
    texts = some_texts(200, 3)
    r = random.Random(1)
    docs = [(r.choice([None, *range(-50, 100)]), t, "x") for t in texts] + [(5, "same", ""), (5, "same", ""), (6, None, "")]
    manifest = token_store.write_store(spark.createDataFrame(docs, DOCS).repartition(5), vocabulary("byte_bpe_50k.json"), 0)
    got = token_store.read_store(manifest).collect()
    ids = library_ids("byte_bpe_50k.json", [d[1] or "" for d in docs], 0)
    want = sorted(((d[0] is not None, d[0] or 0, len(x), zlib.crc32(x.tobytes())) for d, x in zip(docs, ids)))
    assert sorted((g.doc_id is not None, g.doc_id or 0, g.n_tokens, g.ids_crc32) for g in got) == want
    got.sort(key=lambda g: g.start)
    assert [g.start for g in got] == np.cumsum([0] + [g.n_tokens for g in got])[:-1].tolist()
    assert [(g.doc_id is not None, g.doc_id or 0) for g in got] == [w[:2] for w in want]
    row = manifest.filter("n_docs > 0").first()
    shard = token_store.Shard(row.payload, row["index"])
    assert shard.get(10**12) is None
    assert token_store.read_store(token_store.write_store(spark.createDataFrame([], DOCS), vocabulary("byte_bpe_50k.json"), 0)).count() == 0


def test_store_answers_over_all_shards(spark):
    """Hits, misses, null ids and one id in two shards; a task per shard reads back."""
    texts = some_texts(120, 4)
    docs = [(k, t, "x") for k, t in enumerate(texts)] + [(7, t, "y") for t in some_texts(60, 6, 10)] + [(None, "none", "z"), (None, "more", "z")]
    name = vocabulary("byte_bpe_50k.json")
    one = token_store.write_store(spark.createDataFrame(docs[:70], DOCS).coalesce(1), name, 0)
    two = token_store.write_store(spark.createDataFrame(docs[70:], DOCS).coalesce(1), name, 0)
    both = one.union(two.withColumn("shard", two.shard + 1000))
    store = token_store.Store(both)
    ids = library_ids("byte_bpe_50k.json", [d[1] or "" for d in docs], 0)
    for k in (0, 6, 8, 69, 70, 119):
        assert store.get(k).tolist() == ids[k].tolist() and store.get(k, 1) is None
    assert store.get(500) is None and store.get(-1) is None and store.get(None, 2) is None
    sevens = sorted(x.tolist() for d, x in zip(docs, ids) if d[0] == 7)
    assert sorted(store.get(7, k).tolist() for k in range(len(sevens))) == sevens and store.get(7, len(sevens)) is None
    assert sorted(store.get(None, k).tolist() for k in (0, 1)) == sorted(x.tolist() for d, x in zip(docs, ids) if d[0] is None)
    whole = spark.createDataFrame(docs, DOCS).repartition(4)
    manifest = token_store.write_store(whole, name, 0)
    assert token_store.read_store(manifest).rdd.getNumPartitions() >= manifest.count()
