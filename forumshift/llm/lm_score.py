"""Masked pseudo-likelihood scores from a bidirectional window network.

The network predicts a word from the ``REACH`` words on either side of it (its own place is
masked): one table of vectors per relative position, summed through tanh, and a two-level
softmax (class, then member).  A document's score is the sum of log p(word | both sides) over
all its words.

Words are numbered by their counts over the whole corpus: those with ``least_count`` occurrences or
more (about ``SIDE`` squared at least, ``MOST`` squared at most) have numbers of their own, so the
network grows with the corpus; the rest share ``BUCKETS`` numbers by hash.  The network gives
a rare word the probability of its shared number; the word's part of it is its count over the
counts of all words of that number, from the whole table of word counts: those of the most frequent
rare words, ``USUAL_WORDS`` at most, are broadcast, the others joined by shuffling to the distinct
words of every document and never gathered.

For training, words are looked up once and the corpus is staged as numbers, in pieces of at most
``PIECE`` words (a cut is an edge of the text to its neighbours).  A hash of its id and words deals
each piece to one of ``ROUNDS`` rounds and to a learner.  A learner has ``SHARE`` words, or
``SHARE_OF_NUMBER`` for each word number where that is more, so the learners follow the corpus and
not the tasks, files or cores, and take their pieces in the order of the hash: how the input is
partitioned does not matter.  In a round all learners start from one network, learn from their
pieces (each word is a target once in all rounds) and return their changes, whose means, weighted
by words, are taken in two shuffles by blocks of the network; between several learners the mean
changes carry on with ``MOMENTUM``.  The driver and the broadcasts see one network, of a size
bounded by MOST.

Cases: null and empty texts have no words and score 0; words beyond a text's ends are one padding
number; a rare word that the training corpus lacks counts as one more occurrence of its shared
number; very long texts train in pieces and are scored whole; repeated rows score alike and train
in one learner; an empty table trains nothing and gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumshift.llm.shipping import arrow_map
from forumshift.llm.staging import new_folder, stage
from forumshift.llm.wordhash import chunks, mix, text_buffers, words

SIDE = 32                      # classes, and members of a class, of the smallest network
WORDS = SIDE * SIDE            # its numbers; a network's number of numbers itself is padding
MOST = 160                     # classes of the largest network; its numbers and padding fit 16 bits
BUCKETS = 64
REACH, WIDTH, ROUNDS = 2, 24, 8
PIECE = 4096
USUAL_WORDS = 1 << 20          # rare words whose counts are broadcast (16 MB); the others are joined
SHARE, SHARE_OF_NUMBER = 1 << 24, 1024     # words of a learner: at least so many, and for each word number
_RATE, DECAY, MOMENTUM = 3.0, 2.0, 0.5
_STEP_WORDS, _BLOCK, _FAN = 2048, 1 << 16, 1024
_OFFSETS = [k for k in range(-REACH, REACH + 1) if k]
_U = np.uint64
_COUNTED = T.StructType([T.StructField("word", T.LongType()), T.StructField("n", T.LongType())])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw, offsets = text_buffers(b.column(0))
        for lo, hi in chunks(offsets, 4 << 20):
            word, n = np.unique(words(raw, offsets[lo:hi + 1])[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])


def side_for(words: int) -> int:
    """Classes of a network that tells so many words apart."""
    return max(SIDE, math.isqrt(words + BUCKETS - 1) + 1)


def least_count(total: int) -> int:
    """Occurrences from which a word has a number of its own: a third of the root of all, so that the
    words told apart grow with the root of the corpus and each has ever more windows to learn from."""
    return max(1, math.isqrt(total) // 3)


def frequent_words(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, DataFrame, int]:
    """(hashes, counts, rare, words): the corpus's most frequent words, most frequent first (ties by
    hash), whose counts go on with those of the shared numbers; (word, n) of all other words; and
    the number of words in all."""
    counts = stage(arrow_map(texts, _counts, _COUNTED).groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    told = counts.filter(F.col("n") >= least_count(total)).count()
    numbers = min(side_for(told), MOST) ** 2
    top = counts.orderBy(F.desc("n"), "word").limit(numbers - BUCKETS).collect()       # at most MOST squared rows
    n = np.zeros(numbers)
    n[:len(top)] = [r.n for r in top]
    rare = counts.filter(F.lit(False))
    if len(top) == numbers - BUCKETS:
        last = top[-1]
        rare = counts.filter((F.col("n") < last.n) | ((F.col("n") == last.n) & (F.col("word") > last.word)))
        for r in rare.groupBy(_bucket().alias("k")).agg(F.sum("n").alias("n")).collect():   # BUCKETS rows
            n[numbers - BUCKETS + r.k] = r.n
    return np.array([r.word for r in top], np.int64).view(np.uint64), n, rare, total


def _bucket() -> Column:
    """Which shared number a rare word has; as ``Network.numbers``, for BUCKETS divides 2**64."""
    return F.pmod("word", F.lit(BUCKETS))


class Network:
    """Parameters in one flat single-precision vector, so that changes add up block by block."""

    _SLOTS = 1 << 20

    def __init__(self, frequent: np.ndarray, flat: np.ndarray | None = None):
        self.side = side = side_for(len(frequent))
        self.words = side * side
        shapes = [("E", (len(_OFFSETS), self.words + 1, WIDTH)), ("b", (WIDTH,)), ("C", (WIDTH, side)), ("c", (side,)),
                  ("M", (side, WIDTH, side)), ("m", (side, side))]
        self.frequent = frequent
        if flat is None:
            flat = np.random.default_rng(5).normal(0, 0.1, sum(math.prod(x) for _, x in shapes)).astype(np.float32)
        self.flat = flat
        at = 0
        for name, shape in shapes:
            size = math.prod(shape)
            setattr(self, name, flat[at:at + size].reshape(shape))
            at += size
        self.ones = np.ones(side, np.float32)          # a product sums rows faster than sum()
        self.rare: DataFrame | None = None             # (word, n) of the words of the shared numbers
        self.usual = (np.zeros(0, _U), np.zeros(0))    # (hashes, counts) of the most frequent of these
        self.counts, self.shared = np.zeros(self.words), np.zeros(BUCKETS)   # of its words, and of the shared numbers
        order = np.argsort(frequent)
        self.known, self.number = frequent[order], order
        place = (frequent >> _U(40)).astype(np.int64) & (self._SLOTS - 1)
        self.slots = np.full(self._SLOTS, -1, np.int32)                    # number by some bits of the hash;
        self.slots[place] = np.arange(len(frequent))
        self.slots[place[self.slots[place] != np.arange(len(frequent))]] = -2   # -2 where two words have them

    def start_from(self, counts: np.ndarray) -> None:
        """Let the biases say what the counts alone say."""
        share = (counts + 1).reshape(self.side, self.side)
        self.c[:] = np.log(share.sum(1) / share.sum())
        self.m[:] = np.log(share / share.sum(1, keepdims=True))

    def numbers(self, h: np.ndarray) -> np.ndarray:
        out = self.words - BUCKETS + (h % _U(BUCKETS)).astype(np.int64)
        if len(self.known):
            got = self.slots[(h >> _U(40)).astype(np.int64) & (self._SLOTS - 1)]
            one = np.flatnonzero(got >= 0)
            one = one[self.frequent[got[one]] == h[one]]
            out[one] = got[one]
            several = np.flatnonzero(got == -2)
            at = np.searchsorted(self.known, h[several])
            at[at == len(self.known)] = 0
            hit = self.known[at] == h[several]
            out[several[hit]] = self.number[at[hit]]
        return out

    def windows(self, row: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
        """For every offset, the word number there (padding outside the document)."""
        out = []
        for k in _OFFSETS:
            x = np.full(len(ids), self.words)
            a, b = (slice(0, k), slice(-k, None)) if k < 0 else (slice(k, None), slice(0, -k))
            if abs(k) < len(ids):
                same = row[a] == row[b]
                x[b] = np.where(same, ids[a], self.words)
            out.append(x)
        return out

    def hidden(self, around: list[np.ndarray]) -> np.ndarray:
        z = self.E[0].take(around[0], 0) + self.b
        for e, x in zip(self.E[1:], around[1:]):
            z += e.take(x, 0)
        return np.tanh(z, out=z)

    def log_likelihood(self, around: list[np.ndarray], target: np.ndarray) -> np.ndarray:
        """log p(target | window) of every word."""
        order = np.argsort((target // self.side).astype(np.int16), kind="stable")     # a class is a slice
        target = target[order]
        h = self.hidden([x[order] for x in around])
        group, member = target // self.side, target % self.side
        logs = self._picked(h @ self.C + self.c, group)
        edges = np.searchsorted(group, np.arange(self.side + 1)).tolist()
        for g, (a, b) in enumerate(zip(edges, edges[1:])):
            if b > a:
                logs[a:b] += self._picked(h[a:b] @ self.M[g] + self.m[g], member[a:b])
        out = np.empty_like(logs)
        out[order] = logs
        return out

    def learn(self, around: list[np.ndarray], target: np.ndarray, rate: float) -> None:
        """One step down the mean loss of the given windows."""
        n, scale = len(target), np.float32(rate)
        side = self.side
        order = np.argsort((target // side).astype(np.int16), kind="stable")   # by class, so that a class is a slice
        around, target = [x[order] for x in around], target[order]
        h = self.hidden(around)
        group, member = target // side, target % side
        edges = np.searchsorted(group, np.arange(side + 1)).tolist()
        d = self._softmax(h @ self.C + self.c)
        d[np.arange(n), group] -= 1
        dh = d @ self.C.T
        new_c, new_cc = h.T @ d, d.sum(0)
        own = [(g, slice(a, b)) for g, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
        d = self.m.take(group, 0)
        for g, s in own:
            d[s] += h[s] @ self.M[g]
        self._softmax(d)
        d[np.arange(n), member] -= 1
        for g, s in own:
            dh[s] += d[s] @ self.M[g].T
            share = scale / np.float32(math.sqrt(n * (s.stop - s.start)))
            self.M[g] -= share * (h[s].T @ d[s])
            self.m[g] -= share * d[s].sum(0)
        share = scale / np.float32(n)
        self.C -= share * new_c
        self.c -= share * new_cc
        dh *= 1 - h * h
        self.b -= share * dh.sum(0)
        # a word's vector moves by its own windows: their sum over the root of n times its own count
        for e, x in zip(self.E, around):
            order = np.argsort(x.astype(np.uint16), kind="stable")
            ranked = x[order]
            first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
            sums = np.add.reduceat(dh.take(order, 0), first, axis=0)
            count = np.diff(np.append(first, n)).astype(np.float32)
            e[ranked[first]] -= scale * sums / np.sqrt(n * count)[:, None]

    def _softmax(self, x: np.ndarray) -> np.ndarray:
        x -= x.max(axis=1, keepdims=True)
        np.exp(x, out=x)
        x /= (x @ self.ones)[:, None]
        return x

    def _picked(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        x -= x.max(axis=1, keepdims=True)
        own = x[np.arange(len(x)), at]
        np.exp(x, out=x)
        return own - np.log(x @ self.ones)


_PIECES = T.StructType([T.StructField("round", T.IntegerType()), T.StructField("learner", T.IntegerType()),
                        T.StructField("deal", T.LongType()), T.StructField("ids", T.BinaryType())])


def pieces(texts: DataFrame, frequent: np.ndarray, learners: int) -> DataFrame:
    """(round, learner, deal, ids): the words of (id, text) as numbers, in pieces."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(shared.value, None)
        for b in batches:
            raw, offsets = text_buffers(b.column(1))
            keys = b.column(0).fill_null(-1).to_numpy(zero_copy_only=False).view(_U)
            for lo, hi in chunks(offsets):
                row, h = words(raw, offsets[lo:hi + 1])
                if not len(h):
                    continue
                place = np.arange(len(h)) - np.searchsorted(row, np.arange(hi - lo))[row]
                first = np.flatnonzero(place % PIECE == 0)
                said = np.add.reduceat(mix(h + place.astype(_U)), first)
                deal = mix(said + mix(keys[lo:hi][row[first]] + _U(1)))
                learner, turn = deal // _U(ROUNDS) % _U(learners), deal % _U(ROUNDS)
                edges = pa.py_buffer((2 * np.append(first, len(h))).astype(np.int32))
                ids = pa.Array.from_buffers(pa.binary(), len(first), [None, edges, pa.py_buffer(net.numbers(h).astype("<u2"))])
                yield pa.RecordBatch.from_arrays([pa.array(turn.astype(np.int32)), pa.array(learner.astype(np.int32)),
                                                  pa.array(deal.view(np.int64)), ids], names=_PIECES.fieldNames())
    return arrow_map(texts, run, _PIECES)


def train(texts: DataFrame, learners: int | None = None) -> Network:
    """A network of the whole corpus: (id, text), or one column of texts.  ``learners`` is the number
    that the size of the corpus gives unless it is given."""
    spark = texts.sparkSession
    sc = spark.sparkContext
    if len(texts.columns) == 1:
        texts = texts.select(F.lit(0).cast("long").alias("id"), texts.columns[0])
    frequent, counts, rare, total = frequent_words(texts.select(texts.columns[1]))
    net = Network(frequent)
    net.start_from(counts)
    learners = learners or max(1, -(-total // max(SHARE, SHARE_OF_NUMBER * net.words)))
    edges = np.append(np.arange(0, len(net.flat), _BLOCK), len(net.flat)).tolist()
    schema = pa.schema([("block", pa.int64()), ("share", pa.int64()), ("weight", pa.float64()), ("change", pa.binary())])
    fields = T.StructType([T.StructField("block", T.LongType()), T.StructField("share", T.LongType()),
                           T.StructField("weight", T.DoubleType()), T.StructField("change", T.BinaryType())])
    dealt = None
    if len(frequent):
        path = new_folder(spark, "lm-pieces")
        pieces(texts, frequent, learners).write.partitionBy("round").parquet(path)
        dealt = spark.read.schema(_PIECES).parquet(path)

    pace = np.zeros_like(net.flat)
    for turn in range(ROUNDS if dealt is not None else 0):
        shared = sc.broadcast((frequent, net.flat))

        def learned(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            frequent, flat = shared.value
            own, seen, learner = Network(frequent, flat.copy()), 0, 0
            for b in batches:
                for lo in range(0, b.num_rows, 64):
                    ids, row = _numbers(b.column(1).slice(lo, 64))
                    around = own.windows(row, ids)
                    for k in range(0, len(ids), _STEP_WORDS):
                        s = slice(k, k + _STEP_WORDS)
                        own.learn([x[s] for x in around], ids[s], _RATE / (1 + turn * DECAY / ROUNDS))
                    seen += len(ids)
                    learner = b.column(0)[0].as_py()
            if seen:
                change = (own.flat - flat) * np.float32(seen)
                for i, (a, z) in enumerate(zip(edges, edges[1:])):
                    yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([learner % _FAN]), pa.array([float(seen)]),
                                                      pa.array([change[a:z].tobytes()])], schema=schema)

        def summed(part: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in part.column("change"))
            weight = float(np.sum(part.column("weight").to_numpy()))
            return pa.table([pa.array([part.column("block")[0].as_py()]), pa.array([0]), pa.array([weight]),
                             pa.array([total.astype(np.float32).tobytes()])], schema=schema)

        own = dealt.filter(F.col("round") == turn).repartitionById(learners, "learner").sortWithinPartitions("deal", "ids")
        changes = arrow_map(own.select("learner", "ids"), learned, fields)
        changes = changes.groupBy("block", "share").applyInArrow(summed, fields)
        changes = changes.groupBy("block").applyInArrow(summed, fields)
        mean = np.zeros_like(net.flat)
        for r in changes.collect():                                   # one row per block of the network
            mean[edges[r.block]:edges[r.block + 1]] = np.frombuffer(r.change, np.float32) / np.float32(r.weight)
        pace = np.float32(MOMENTUM if learners > 1 else 0) * pace + mean
        net = Network(frequent, net.flat + pace)
        shared.unpersist()
    net.rare, net.counts, net.shared = rare, counts, counts[net.words - BUCKETS:]
    net.usual = _usual(rare)
    return net


def _usual(rare: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes ascending, counts) of the most frequent rare words, USUAL_WORDS at most."""
    step = F.floor(F.log2("n") * 4).cast("long")                       # 256 steps of counts at most
    sizes = sorted(((r.step, r.words) for r in rare.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()), reverse=True)
    least, held = None, 0
    for k, words_ in sizes:
        held += words_
        if held > USUAL_WORDS:
            break
        least = k
    if least is None:
        return np.zeros(0, _U), np.zeros(0)
    table = rare.filter(step >= least).select("word", "n").toArrow()
    word = table.column("word").to_numpy().view(_U)
    order = np.argsort(word)
    return word[order], table.column("n").to_numpy()[order].astype(float)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, piece of each) of a column of pieces."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] // 2
    ids = np.frombuffer(column.buffers()[2], "<u2")[offsets[0]:offsets[-1]].astype(np.int64)
    return ids, np.repeat(np.arange(len(column)), np.diff(offsets))


def score(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, log_likelihood (summed over the words) of every document."""
    if net is None:
        net = train(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")))
    usual, n = net.usual
    known = np.log(n / net.shared[(usual % _U(BUCKETS)).astype(np.int64)]) if len(usual) else n
    shared = docs.sparkSession.sparkContext.broadcast((net.frequent, net.flat, usual, known))
    longs = pa.list_(pa.int64())
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_likelihood", pa.float64()),
                        ("word", longs), ("times", longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, flat, usual, known = shared.value
        own, done = Network(frequent, flat), TaskContext.get().partitionId() << 33
        for b in batches:
            raw, offsets = text_buffers(b.column(1))
            for lo, hi in chunks(offsets):
                row, h = words(raw, offsets[lo:hi + 1])
                ids = own.numbers(h)
                around, logs = own.windows(row, ids), np.zeros(len(ids))
                for k in range(0, len(ids), 1 << 14):
                    s = slice(k, k + (1 << 14))
                    logs[s] = own.log_likelihood([x[s] for x in around], ids[s])
                at, word, times = _rare_words(row, h, ids >= own.words - BUCKETS)
                logs = np.bincount(row, weights=logs, minlength=hi - lo)
                if len(usual):
                    place = np.searchsorted(usual, word)
                    place[place == len(usual)] = 0
                    hit = usual[place] == word
                    logs += np.bincount(at[hit], weights=times[hit] * known[place[hit]], minlength=hi - lo)
                    at, word, times = at[~hit], word[~hit], times[~hit]
                edges = pa.array(np.searchsorted(at, np.arange(hi - lo + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(done, done + hi - lo)), b.column(0).slice(lo, hi - lo),
                    pa.array(np.bincount(row, minlength=hi - lo)), pa.array(logs),
                    pa.ListArray.from_arrays(edges, pa.array(word.view(np.int64))),
                    pa.ListArray.from_arrays(edges, pa.array(times))], schema=schema)
                done += hi - lo

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = stage(arrow_map(rows, run, T.StructType([
        T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("log_likelihood", T.DoubleType()), T.StructField("word", T.ArrayType(T.LongType())),
        T.StructField("times", T.ArrayType(T.LongType()))])), "lm-parts")
    rare = parts.select("row", F.inline(F.arrays_zip("word", "times"))).join(net.rare, "word", "left")
    shared_count = F.array(*[F.lit(float(x)) for x in net.shared])[_bucket()]
    share = F.log(F.coalesce(F.col("n") / shared_count, 1 / (shared_count + 1)))
    rare = rare.select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_words"),
                       (F.col("times") * share).alias("log_likelihood"))
    return parts.select(rare.columns).union(rare).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_words").alias("n_words"),
        F.sum("log_likelihood").alias("log_likelihood")).drop("row")


def _rare_words(row: np.ndarray, h: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, times) of the distinct words of every row that have a shared number, by row."""
    row, h = row[rare], h[rare]
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return row[first], h[first], np.diff(np.append(first, len(h)))
