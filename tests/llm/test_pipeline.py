"""The pipeline, stage by stage, against plain versions of what each stage decides."""

import re
import zlib

import numpy as np

import corpus_pipeline
from forumshift.llm import queries, staging
from forumshift.llm.staging import stage
from tests.llm.helpers import benchmark_hits, fold, near_components, personal_data
from tests.llm.test_tokens import library_ids


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    names = docs.columns
    steps, frames = [], [rows(docs)]
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, sf001), f"test-{name}")
        steps.append(name)
        frames.append(docs)
        if name != "packing":
            assert docs.columns == names
            frames[-1] = rows(docs)
    given, good, single, clean, private, packed = frames

    score = {r.doc_id: r.predicted for r in queries.op4_quality(spark, sf001).collect()}
    assert set(good) == {k for k in given if score[k] == 1}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf001}/labels.parquet").collect()}
    assert all(k in good for k in given if labels.get(k) == 1)

    component = near_components([(k, r.text) for k, r in good.items()], 5)
    assert set(single) == {k for k, (n, c) in component.items() if c == k}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf001}/benchmark.parquet").collect()]
    for k, r in single.items():
        words, hit, _ = benchmark_hits(r.text, items, 10)
        if len(hit) > 0.8 * len(words):
            assert k not in clean
        else:
            left = [w for i, w in enumerate(words) if i not in hit]
            assert re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(clean[k].text)) == left
            assert hit or clean[k].text == r.text

    for k, r in clean.items():
        text = r.text
        for _, a, b in sorted(personal_data(text), key=lambda s: -s[1]):
            assert text[a:b] not in private[k].text
        assert personal_data(private[k].text) == []
        assert private[k].n_chars == len(private[k].text)

    ids = dict(zip(private, library_ids("word_bpe_49k.json", [r.text for r in private.values()], 2)))
    seen = {k: 0 for k in ids}
    for p in packed.collect():
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes())
        seen[p.doc_id] += p.length
    assert seen == {k: len(x) for k, x in ids.items()}


def test_registered_queries_cover_the_operators(spark):
    assert sorted(queries.queries()) == sorted(["pipeline"] + [k for k in queries.queries() if re.match(r"op\d+_", k)])
    assert {int(k[2:].split("_")[0]) for k in queries.queries() if k != "pipeline"} == set(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None and np.all([k in queries.queries() for k in queries.oracle_sql()])


def test_edges_through_the_whole_pipeline(spark, tmp_path):
    """Nulls, empty and very long texts, repeats, a null id, a clashing column; then an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string"
    long = " ".join(f"word{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, long), (5, long), (6, "mail a@b.org now, or not at all."), (6, "mail a@b.org now, or not at all."),
            (None, "no id but a text of its own"), (7, "what is asked in this one test item of ten words exactly today")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows], schema)
    folder = str(tmp_path)
    labels = spark.createDataFrame([(4, 1, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "what is asked in this one test item of ten words exactly today"), (2, None)], "item_id long, text string")
    labels.write.parquet(f"{folder}/labels.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    before = staging.staged()
    packed = corpus_pipeline.run(spark, folder)
    assert len(staging.staged()) == len(before) + 1               # only the last stage's folder is left
    tokens = {}
    for p in packed.collect():
        tokens[p.doc_id] = tokens.get(p.doc_id, 0) + p.length
    assert set(tokens) == {1, 2, 3, 4, 6, None} and tokens[1] == tokens[2] == 1 and tokens[4] > 60_000
    staging.drop_stages(spark, staging.staged()[len(before):])
    docs.limit(0).write.parquet(f"{folder}/none/documents.parquet")
    items.limit(0).write.parquet(f"{folder}/none/benchmark.parquet")
    labels.limit(0).write.parquet(f"{folder}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0
