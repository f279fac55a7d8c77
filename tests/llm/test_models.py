"""Quality classifier, language-model scores and embedding links."""

import numpy as np
import pytest

from forumshift.llm import embeddings, lm_score, quality, queries
from forumshift.llm.components import star


def test_classifier_is_right_on_held_out_rows(spark, sf01):
    got = queries.op4_quality(spark, sf01).toPandas().merge(spark.read.parquet(f"{sf01}/labels.parquet").toPandas(), on="doc_id")
    own = got[got.held_out]
    assert len(own) > 50
    assert ((own.score >= 0.3).astype(int) == own.predicted).all()
    assert (own.predicted == own.quality).mean() > 0.95
    assert own.predicted[own.quality == 1].mean() > 0.98


def test_gradient():
    model = quality.Model()
    r = np.random.default_rng(0)
    model.prior, model.p["w"] = None, r.normal(size=model.p["w"].shape)
    x, first, y = r.normal(size=(9, quality.FEATURES)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])

    def loss():
        z = model._forward(x, first)["logit"]
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    grad = model._gradient(model._forward(x, first), y)
    for name, p in model.p.items():
        at = tuple(r.integers(0, s) for s in p.shape)
        old = p[at]
        p[at] = old + 1e-5
        up = loss()
        p[at] = old - 1e-5
        down = loss()
        p[at] = old
        assert abs((up - down) / 2e-5 - grad[name][at]) < 1e-6, name


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b"), (3, "word " * 30_000, "c"), (None, "x", "d")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.scores(docs, model).collect()
    assert len(got) == 5 and all(r.score == 1.0 for r in got)      # one label alone: its share
    assert quality.fit(docs, labels.limit(0)).prior == 0.5
    assert quality.scores(docs.limit(0), model).count() == 0
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == 5


def test_scores_are_the_sum_over_words(spark):
    r = np.random.default_rng(3)
    texts = [" ".join(r.choice(["a", "b", "c", "dd", "ee"], r.integers(0, 40))) for _ in range(120)] + [None, "", "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    net = lm_score.train(docs.select("text"))
    got = {x.doc_id: x for x in lm_score.score(docs, net).collect()}
    from forumshift.llm.wordhash import text_buffers, words
    import pyarrow as pa
    for k, t in enumerate(texts):
        raw, at = text_buffers(pa.array([t or "x"]))
        ids = net.numbers(words(raw, at)[1]).tolist() if (t or "").split() else []
        total = 0.0
        for i, target in enumerate(ids):                           # one word at a time, from the definition
            z = net.b.astype(float).copy()
            for e, o in zip(net.E, lm_score._OFFSETS):
                z += e[ids[i + o] if 0 <= i + o < len(ids) else lm_score.WORDS]
            h = np.tanh(z)
            g, m = divmod(target, lm_score.SIDE)
            for logits, own in ((h @ net.C + net.c, g), (h @ net.M[g] + net.m[g], m)):
                total += logits[own] - np.log(np.exp(logits).sum())
        assert got[k].n_words == len(ids) and abs(got[k].log_likelihood - total) < 1e-3 * max(1, len(ids))


def test_training_beats_counts_where_neighbours_tell(spark):
    text = " ".join(f"left{k} mid{k} right{k}" for k in range(8))
    docs = spark.createDataFrame([(k, text) for k in range(400)], "doc_id long, text string")
    got = lm_score.score(docs).first()
    assert got.log_likelihood / got.n_words > -np.log(24)          # what counts alone would give
    assert lm_score.score(docs.limit(0)).count() == 0


def test_rare_words_score_by_their_own_counts(spark):
    from forumshift.llm.wordhash import text_buffers, words
    import pyarrow as pa
    h = words(*text_buffers(pa.array([" ".join(f"w{k}" for k in range(3000))])))[1]
    bucket = (h % np.uint64(lm_score.BUCKETS)).astype(int)
    one, two = np.flatnonzero(bucket == bucket[0])[:2]
    other = [k for k in range(3000) if k not in (one, two)][:1500]
    frequent, rare = other[:lm_score.WORDS - lm_score.BUCKETS], other[lm_score.WORDS - lm_score.BUCKETS:]
    corpus = [" ".join(f"w{k}" for k in frequent)] * 9 + [" ".join(f"w{k}" for k in [*rare, one, one, one, one, one, two])]
    net = lm_score.train(spark.createDataFrame([(t,) for t in corpus], "text string"))
    texts = [f"w{one}", f"w{two}", f"w{one} w{two} w{one}", f"w{frequent[0]}", "unseen"]
    docs = spark.createDataFrame([*enumerate(texts), (None, f"w{two}"), (1, f"w{two}")], "doc_id long, text string")
    got = [(r.doc_id, r.n_words, r.log_likelihood) for r in lm_score.score(docs, net).collect()]
    n = {r.word: r.n for r in net.rare.collect()}
    total = sum(c for w, c in n.items() if w % lm_score.BUCKETS == bucket[one])
    assert len(n) == len(rare) + 2 and total == net.shared[bucket[one]] and len(got) == 7
    score = {k: s for k, _, s in got}
    assert abs(score[0] - score[1] - np.log(5)) < 1e-6             # one number, five times the count
    around = [np.array([lm_score.WORDS])] * len(lm_score._OFFSETS)
    assert abs(score[1] - net.log_likelihood(around, net.numbers(h[[one]]))[0] + np.log(total)) < 1e-5
    assert [k for k, _, _ in got].count(1) == 2 and abs(score[None] - score[1]) < 1e-9
    assert np.isfinite(score[4]) and dict((k, w) for k, w, _ in got)[2] == 3


def test_every_word_is_a_target_once(spark, monkeypatch):
    """The pieces hold every word of every text once, each piece in one round of one learner; how the
    input is partitioned changes nothing."""
    monkeypatch.setattr(lm_score, "PIECE", 7)
    r = np.random.default_rng(4)
    texts = [None, "", " ", *(" ".join(r.choice(["a", "b", "cc", "d" * 40], r.integers(1, 60))) for _ in range(80))]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    h = words_of(" ".join(t for t in texts if t))
    frequent = np.unique(h)
    net = lm_score.Network(frequent)
    dealt = [sorted((x.deal, x.round, x.learner, bytes(x.ids)) for x in
                    lm_score.pieces(docs.repartition(k), frequent, 3).collect()) for k in (1, 9)]
    assert dealt[0] == dealt[1] and max(len(x[3]) for x in dealt[0]) == 14
    assert {x[1] for x in dealt[0]} == set(range(lm_score.ROUNDS)) and {x[2] for x in dealt[0]} == {0, 1, 2}
    held = sorted(np.concatenate([np.frombuffer(x[3], "<u2") for x in dealt[0]]).tolist())
    assert held == sorted(net.numbers(h).tolist())


def words_of(text):
    import pyarrow as pa
    from forumshift.llm.wordhash import text_buffers, words
    return words(*text_buffers(pa.array([text])))[1]


def test_training_does_not_depend_on_partitions(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text")
    for learners in (None, 3):
        nets = [lm_score.train(docs.repartition(k), learners) for k in (1, 40)]
        assert np.abs(nets[0].flat - nets[1].flat).max() < 1e-5


def test_training_beats_counts(spark, sf01):
    """At any number of learners the network says more than the counts of words alone."""
    docs = spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text")

    def mean(net):
        rows = lm_score.score(docs, net).collect()
        return sum(x.log_likelihood for x in rows) / sum(x.n_words for x in rows)

    one, four = lm_score.train(docs), lm_score.train(docs, 4)
    counted = lm_score.Network(one.frequent)
    counted.start_from(one.counts)
    counted.E[:], counted.C[:], counted.M[:] = 0, 0, 0
    counted.rare, counted.shared = one.rare, one.shared
    least = mean(counted)
    assert mean(one) > least + 0.3 and mean(four) > least + 0.1        # four learners of 0.1 M words each


def test_broadcast_and_joined_counts_score_alike(spark, monkeypatch):
    """Rare words whose counts are broadcast, and the same words joined from the table of counts."""
    r = np.random.default_rng(8)
    words = [f"w{k}" for k in range(2600)]
    share = 1 / np.arange(1, 2601)
    texts = [" ".join(r.choice(words, r.integers(1, 80), p=share / share.sum())) for _ in range(400)] + ["unseenword w1", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    corpus, found, sizes = docs.filter("doc_id < 400"), [], []
    for most in (1 << 20, -1, 0):                                  # all, all but the rarest, none
        monkeypatch.setattr(lm_score, "USUAL_WORDS", most if most >= 0 else sizes[0] - 1)
        net = lm_score.train(corpus)
        sizes.append(len(net.usual[0]))
        found.append({x.doc_id: x.log_likelihood for x in lm_score.score(docs, net).collect()})
    assert sizes[0] > sizes[1] > 0 == sizes[2]
    for k in found[0]:
        assert abs(found[0][k] - found[1][k]) < 1e-6 and abs(found[0][k] - found[2][k]) < 1e-6


def test_words_told_apart_follow_the_counts():
    assert lm_score.side_for(10) == lm_score.SIDE
    for words in (960, 961, 5000, 40_000):
        side = lm_score.side_for(words)
        assert side ** 2 >= words + lm_score.BUCKETS > (side - 1) ** 2 or side == lm_score.SIDE
    net = lm_score.Network(np.arange(7, 40_007, dtype=np.uint64) << np.uint64(38))     # several words in a slot
    assert net.numbers(net.frequent).tolist() == list(range(40_000))
    assert (net.numbers(np.array([1, 2 ** 63], np.uint64)) >= net.words - lm_score.BUCKETS).all()


def test_learning_step():
    """A step as before, class by class: the change of every parameter from its definition."""
    r = np.random.default_rng(6)
    net = lm_score.Network(np.arange(10, dtype=np.uint64))
    net.flat[:] = r.normal(0, 0.3, len(net.flat))
    old = lm_score.Network(net.frequent, net.flat.copy())
    target = r.choice([0, 1, 5, 33, 70, 1000, 1023], 300)
    around = [r.integers(0, lm_score.WORDS + 1, 300) for _ in lm_score._OFFSETS]
    net.learn(around, target, 0.5)
    n, g, m = len(target), target // lm_score.SIDE, target % lm_score.SIDE
    h = np.tanh(sum(e[x] for e, x in zip(old.E, around)) + old.b)

    def error(logits, at):
        p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
        p[np.arange(n), at] -= 1
        return p

    d = error(h @ old.C + old.c, g)
    dm = error(np.einsum("nw,nws->ns", h, old.M[g]) + old.m[g], m)
    dh = (d @ old.C.T + np.einsum("ns,nws->nw", dm, old.M[g])) * (1 - h * h)
    want = lm_score.Network(old.frequent, old.flat.copy())
    want.C -= 0.5 / n * (h.T @ d)
    want.c -= 0.5 / n * d.sum(0)
    want.b -= 0.5 / n * dh.sum(0)
    for k in set(g.tolist()):
        own = g == k
        want.M[k] -= 0.5 / np.sqrt(n * own.sum()) * (h[own].T @ dm[own])
        want.m[k] -= 0.5 / np.sqrt(n * own.sum()) * dm[own].sum(0)
    for e, x in zip(want.E, around):
        for w in set(x.tolist()):
            e[w] -= 0.5 * dh[x == w].sum(0) / np.sqrt(n * (x == w).sum())
    assert np.abs(net.flat - want.flat).max() < 1e-4 and np.abs(net.flat - old.flat).max() > 1e-2


@pytest.mark.parametrize("tile", [16, 4096])
def test_links_match_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    r = np.random.default_rng(2)
    base = r.normal(size=(20, 24))
    x = np.concatenate([base[r.integers(0, 20, 150)] + r.normal(size=(150, 24)) * r.uniform(0, 0.5, (150, 1)), base, base * 3])
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x.astype(np.float32))]
    other = [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [1.0, None]), (904, []), (905, [1e300, 1e300]),
             (906, [2.0, 2.0]), (906, [2.0, 2.0]), (907, [float("inf")] * 24)]
    got = {}
    for f in embeddings.near_duplicates(spark.createDataFrame(rows + other, "vec_id long, embedding array<double>")).collect():
        got[f.vec_id] = (f.n_links, f.component_id, f.kept)
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    i, j = np.nonzero(unit @ unit.T >= 0.9)
    i, j = i[i != j], j[i != j]
    low = star(i, j, len(rows))
    for k in range(len(rows)):
        assert got[k] == (int((i == k).sum()), int(low[k]), bool(low[k] == k))
    for k in (900, 901, 902, 903, 904, 907):
        assert got[k] == (0, k, True)
    assert got[905] == (2, 905, True) and got[906] == (2, 905, False)
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_quantisation_bound_holds():
    r = np.random.default_rng(1)
    x = r.normal(size=(200, 48)) * r.uniform(0.01, 1, (1, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, s, e = embeddings.quantise(x)
    near = (q.astype(float) @ q.astype(float).T) * np.outer(s, s)
    size = s * np.linalg.norm(q.astype(float), axis=1)
    assert (np.abs(x @ x.T - near) <= np.outer(size, e) + np.outer(e, size) + np.outer(e, e) + 1e-12).all()


def test_open_pairs_are_decided_in_full_precision(spark, monkeypatch):
    """Pairs right at the threshold: bounds leave them open, full vectors decide; tiles are tasks."""
    monkeypatch.setattr(embeddings, "TILE", 8)
    r = np.random.default_rng(5)
    rows = []
    for k in range(40):
        a = r.normal(size=16)
        a /= np.linalg.norm(a)
        b = r.normal(size=16)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        near = 0.9 + r.choice([-1, 1]) * 10.0 ** -r.integers(3, 9)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (near * a + np.sqrt(1 - near ** 2) * b).tolist())]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen = []
    original = embeddings._tile
    monkeypatch.setattr(embeddings, "_tile", lambda *x: seen.append(x[-1]) or original(*x))
    got = {f.vec_id: (f.n_links, f.component_id) for f in embeddings.near_duplicates(docs).collect()}
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    i, j = np.nonzero(unit @ unit.T >= 0.9)
    i, j = i[i != j], j[i != j]
    low = star(i, j, len(rows))
    assert got == {k: (int((i == k).sum()), int(low[k])) for k in range(len(rows))}
    assert seen == [False, True] and 0 < len(i) < 80
