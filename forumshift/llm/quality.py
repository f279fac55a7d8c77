"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage of every document is
described by its byte classes and word statistics and encoded by a small network; gated attention
weights, learned from document labels alone, mix the encodings into one, which is scored.

Learning takes at most ``FIT_ROWS`` labelled rows (a documented bound; chosen by hash of their
id).  The executors describe their passages; the driver trains on the descriptions.  Scoring
reads whole texts and shuffles nothing.

Cases: null and empty texts are one empty passage and get a score like any other; labelled rows
with a null or contradictory label are not learned from; without both labels to learn from, every
score is the share of ones (0.5 if there is none); repeated rows score alike; an empty table gives
an empty result; other columns are ignored (scores) or passed through (filter).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumshift.llm.rows import keep_rows
from forumshift.llm.shipping import arrow_map
from forumshift.llm.wordhash import chunks, mix, text_buffers, words_at

PASSAGE = 64                   # words
FIT_ROWS = 6_000               # labelled documents learned from, at most
_HIDDEN, _GATE, _EPOCHS, _BAGS, _RATE = 24, 12, 40, 128, 0.01

# byte classes: other control, upper, lower, digit, space, line break, full stop and comma, bar,
# exclamation and question marks, quotes and brackets, other ASCII marks, non-ASCII
_CLASSES = 12
_CLASS = np.zeros(256, np.int64)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n\r",
                             b".,;:", b"|", b"!?", b"'\"()[]{}<>", b"#$%&*+-/=@\\^_`~", bytes(range(128, 256))), 1):
    _CLASS[list(_chars)] = _k
FEATURES = _CLASSES + 9


def describe(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per chunk: (features of every passage, first passage of every row)."""
    raw, offsets = text_buffers(column)
    for lo, hi in chunks(offsets):
        at = offsets[lo:hi + 1]
        row, start, end, h = words_at(raw, at)
        n = hi - lo
        first_word = np.searchsorted(row, np.arange(n + 1))
        passages = np.maximum(1, -(-np.diff(first_word) // PASSAGE))
        first = np.concatenate(([0], np.cumsum(passages)))
        total = first[-1]
        place = np.arange(len(row)) - first_word[row]
        owner = first[row] + place // PASSAGE
        begins = np.zeros(total + 1, np.int64)
        begins[first[:-1]] = at[:-1] - at[0]
        begins[-1] = at[-1] - at[0]
        later = (place % PASSAGE == 0) & (place > 0)
        begins[owner[later]] = start[later]
        size = np.diff(begins)
        of_byte = np.repeat(np.arange(total), size)
        kinds = np.bincount(of_byte * _CLASSES + _CLASS[raw[at[0]:at[-1]]], minlength=total * _CLASSES)
        x = np.zeros((total, FEATURES))
        x[:, :_CLASSES] = kinds.reshape(total, _CLASSES) / np.maximum(size, 1)[:, None]

        def count(mask: np.ndarray) -> np.ndarray:
            return np.bincount(owner[mask], minlength=total)

        n_words = np.bincount(owner, minlength=total)
        per = np.maximum(n_words, 1)
        length = (end - start).astype(float)
        mean = np.bincount(owner, weights=length, minlength=total) / per
        again = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        kind = np.unique(h ^ mix(owner.astype(np.uint64)), return_index=True)[1]
        rank = np.bincount(owner[kind], minlength=total)
        buf = raw[at[0]:at[-1]]
        if len(buf):
            head, tail = _CLASS[buf[start]], _CLASS[buf[np.maximum(end - 1, 0)]]
        else:
            head = tail = np.zeros(0, np.int64)
        x[:, _CLASSES:] = np.stack([
            np.log1p(n_words), mean / 10, np.sqrt(np.maximum(
                0, np.bincount(owner, weights=length ** 2, minlength=total) / per - mean ** 2)) / 10,
            np.bincount(owner[1:][again], minlength=total) / per, rank / per, count(length <= 3) / per,
            count(head == 1) / per, count((tail > 6) & (tail < 11)) / per, np.log1p(size)], axis=1)
        yield x.astype(np.float32), first


class Model:
    """Encoder, gated attention and output layer; ``score`` maps bags of passages to 0..1."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        self.mean, self.std = np.zeros(FEATURES), np.ones(FEATURES)
        self.prior: float | None = 0.5
        self.p = {"W": r.normal(0, FEATURES ** -0.5, (FEATURES, _HIDDEN)), "b": np.zeros(_HIDDEN),
                  "V": r.normal(0, _HIDDEN ** -0.5, (_HIDDEN, _GATE)), "U": r.normal(0, _HIDDEN ** -0.5, (_HIDDEN, _GATE)),
                  "w": np.zeros(_GATE), "c": r.normal(0, 0.1, _HIDDEN), "d": np.zeros(1)}

    def _forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        p, size = self.p, np.diff(first)
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        top = np.maximum.reduceat(e, first[:-1])
        a = np.exp(e - np.repeat(top, size))
        a /= np.repeat(np.add.reduceat(a, first[:-1]), size)
        z = np.add.reduceat(a[:, None] * h, first[:-1])
        return {"x": x, "size": size, "h": h, "t": t, "g": g, "a": a, "z": z, "logit": z @ p["c"] + p["d"][0]}

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(first) - 1, self.prior)
        out = self._forward((x - self.mean) / self.std, first)["logit"]
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))

    def _gradient(self, f: dict, y: np.ndarray) -> dict[str, np.ndarray]:
        p, size = self.p, f["size"]
        d = (1 / (1 + np.exp(-f["logit"])) - y) / len(y)
        dz = np.repeat(d[:, None] * p["c"], size, axis=0)
        da = (dz * f["h"]).sum(axis=1)
        starts = np.cumsum(size) - size
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), size))
        dt, dg = de[:, None] * p["w"] * f["g"], de[:, None] * p["w"] * f["t"]
        dt, dg = dt * (1 - f["t"] ** 2), dg * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ d, "d": np.array([d.sum()])}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, seed: int = 12) -> Model:
        """Adam on the mean log loss, over shuffled groups of bags."""
        if len(set(labels.tolist())) < 2:
            self.prior = float(labels.mean()) if len(labels) else 0.5
            return self
        self.prior = None
        every = np.concatenate(bags).astype(np.float64)
        self.mean, self.std = every.mean(0), every.std(0) + 1e-3
        bags = [(x - self.mean) / self.std for x in bags]
        r, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for epoch in range(_EPOCHS):
            rate = _RATE * (1 - epoch / _EPOCHS) + 1e-4
            order = r.permutation(len(bags))
            for lo in range(0, len(order), _BAGS):
                own = order[lo:lo + _BAGS]
                first = np.concatenate(([0], np.cumsum([len(bags[i]) for i in own])))
                f = self._forward(np.concatenate([bags[i] for i in own]), first)
                step += 1
                for k, g in self._gradient(f, labels[own].astype(float)).items():
                    g = g + 1e-5 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("label", pa.int64()), ("bag", pa.binary())])
    for b in batches:
        bags = [x[i:j].tobytes() for x, first in describe(b.column(1)) for i, j in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bags, pa.binary())], schema=schema)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Model:
    """A model of at most ``rows`` labelled documents (labels 0 and 1)."""
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna().filter("label IN (0, 1)")
    own = own.groupBy("id").agg(F.min("label").cast("long").alias("label"), F.max("label").alias("top"))
    own = own.filter("label = top").select("id", "label").orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.join(F.broadcast(own), "id")                        # at most ``rows`` pairs of numbers
    texts = texts.groupBy("id").agg(F.max("label").alias("label"), F.max("text").alias("text"))   # one text of a repeated id
    got = arrow_map(texts.select("label", "text"), _bags, T.StructType([
        T.StructField("label", T.LongType()), T.StructField("bag", T.BinaryType())])).collect()
    got.sort(key=lambda r: (r.label, bytes(r.bag)))                   # the same model however rows arrive
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, FEATURES) for r in got]
    return Model().fit(bags, np.array([r.label for r in got], np.int64))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row, from its whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for x, first in describe(b.column(1)):
                n = len(first) - 1
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, n), pa.array(model.score(x, first), pa.float64())], schema=schema)
                at += n

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())]))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``."""
    def make():
        def mask(column: pa.Array) -> pa.Array:
            parts = [model.score(x, first) >= threshold for x, first in describe(column)]
            return pa.array(np.concatenate(parts) if parts else np.zeros(0, bool))
        return mask
    return keep_rows(docs, text_col, make)
