"""Exact substring deduplication with suffix automata of reference shards.

A window is ``window`` consecutive words of one document.  A word is removed when a window that
covers it also starts earlier in the corpus: in a document of a smaller id, or further up in the
same one.  The reference is the corpus itself, so its automata cannot be broadcast, for they
would grow with it.  It is cut into shards that hold everything a match needs, and the streams
go to their shard:

1. A window's *anchor* is its least hash of ``ANCHOR`` words; equal windows have equal anchors.
   Consecutive windows with one anchor place are a *stretch*, about seven windows.  Anchors are
   counted over the corpus (pre-aggregated numbers, no text).
2. A Bloom filter of the anchors that occur twice, of at most ``FILTER_BITS`` bits, marks the
   stretches that may be repeated; all others cannot be and are not looked at again.
3. The words of the marked stretches go to the shard of their anchor; equal stretches of a chunk
   go once, with their earliest place.  Where an anchor occurs ``HOT`` times or more, each window
   goes to the shard of its own hash instead, so a common line between ever different words does
   not fill one shard.
4. A shard's distinct stretches build a suffix automaton whose states know where they end first.
   The stretches stream through it; where the match reaches ``window`` words and its state ended
   earlier, the window repeats.  A shard is closed when it holds ``SHARD_WORDS`` words, so memory
   is bounded.
5. The windows that are first come back to their documents; all other marked ones are removed.

Hashes place and filter; automata compare the words themselves.

Cases: null and empty texts have no words; texts of fewer words than a window keep all of them; a
null id comes before all others; rows of one id are ordered by the hash of their text, and rows
equal in both are one document, each returned; very long texts are one chunk; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumshift.llm.bloom import Filter, build
from forumshift.llm.shipping import arrow_map
from forumshift.llm.staging import stage
from forumshift.llm.wordhash import chunks, mix, text_buffers, words_at

ANCHOR = 8
HOT = 2000
SHARD_WORDS = 50_000
_CHUNK = 4 << 20
_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)


def _rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on."""
    n = max(0, len(h) - k + 1)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * _STEP + h[j:j + n]
    return mix(out)


def _least(g: np.ndarray, m: int) -> np.ndarray:
    """Place of the first least of every m consecutive values."""
    at, size = np.arange(len(g), dtype=np.int64), 1
    while size < m:
        step = min(size, m - size)
        a, b = at[:len(at) - step], at[step:]
        at = np.where(g[a] <= g[b], a, b)
        size += step
    return at


def stretches(row: np.ndarray, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor hash) of the stretches of consecutive rows."""
    k = min(ANCHOR, window)
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    grams = _rolled(h, k)
    anchor = _least(grams, window - k + 1)[:n]
    inside = row[:n] == row[window - 1:]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1]) | (row[1:n] != row[:n - 1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    keep = inside[first]
    return first[keep], size[keep], grams[anchor[first[keep]]]


def _anchor_counts(texts: DataFrame, window: int) -> DataFrame:
    """(h, n): how often each anchor occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = text_buffers(b.column(0))
            for lo, hi in chunks(offsets, _CHUNK):
                row, _, _, h = words_at(raw, offsets[lo:hi + 1])
                value, n = np.unique(stretches(row, h, window)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])
    return arrow_map(texts, run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


_KEY = [T.StructField("doc_id", T.LongType()), T.StructField("tie", T.LongType())]
_MARKED = T.StructType(_KEY + [T.StructField("n_words", T.LongType()), T.StructField("words", T.StringType()),
                               T.StructField("start", T.ArrayType(T.LongType())), T.StructField("n", T.ArrayType(T.LongType())),
                               T.StructField("h", T.ArrayType(T.LongType()))])


def _joined(raw: np.ndarray, offsets: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Each row's words with one space between them."""
    size = end - start
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    out_at = np.zeros(len(row) + 1, np.int64)
    np.cumsum(size + ~last, out=out_at[1:])
    out = np.full(int(out_at[-1]), 32, np.uint8)
    buf = raw[offsets[0]:offsets[-1]]
    change = np.zeros(len(buf) + 1, np.int8)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    into = np.zeros(len(out) + 1, np.int8)
    np.add.at(into, out_at[:-1], 1)
    np.add.at(into, out_at[:-1] + size, -1)
    out[np.cumsum(into[:-1], dtype=np.int8) > 0] = buf[np.cumsum(change[:-1], dtype=np.int8) > 0]
    edges = out_at[np.searchsorted(row, np.arange(len(offsets)))]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(edges), pa.py_buffer(out)]).cast(pa.string())


def _marked(docs: DataFrame, window: int, repeated: tuple) -> DataFrame:
    """Every document's words and the stretches of it that may be repeated."""
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(*shared.value)
        for b in batches:
            raw, offsets = text_buffers(b.column(2))
            for lo, hi in chunks(offsets, _CHUNK):
                own = offsets[lo:hi + 1]
                row, start, end, h = words_at(raw, own)
                first, n, anchor = stretches(row, h, window)
                hit = known.has(anchor)
                first, n, anchor = first[hit], n[hit], anchor[hit]
                begin = np.searchsorted(row, np.arange(hi - lo + 1))
                edges = pa.array(np.searchsorted(first, begin).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(np.diff(begin)),
                    _joined(raw, own, row, start, end),
                    *[pa.ListArray.from_arrays(edges, pa.array(x)) for x in
                      (first - begin[row[first]] if len(first) else first, n, anchor.view(np.int64))]], names=_MARKED.fieldNames())
    return arrow_map(docs, run, _MARKED)


_PIECE = T.StructType([T.StructField("shard", T.LongType())] + _KEY +
                      [T.StructField("at", T.LongType()), T.StructField("words", T.BinaryType())])
_PIECE_ARROW = pa.schema([("shard", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("at", pa.int64()), ("words", pa.binary())])


def _pieces(marked: DataFrame, window: int, hot: tuple) -> DataFrame:
    """The words of the marked stretches, to the shard that has all their repeats."""
    shared = marked.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowded = Filter(*shared.value)
        for b in batches:
            raw, offsets = text_buffers(b.column(2))
            listed = [(c.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(c.value_lengths().to_numpy(zero_copy_only=False))))
                      for c in (b.column(3), b.column(4), b.column(5))]
            edges = listed[0][1]
            for lo, hi in chunks(offsets, _CHUNK):
                own = offsets[lo:hi + 1]
                row, start, end, h = words_at(raw, own)
                begin = np.searchsorted(row, np.arange(hi - lo + 1))
                first, n, anchor = [x[0][edges[lo]:edges[hi]] for x in listed]
                of = np.repeat(np.arange(hi - lo), np.diff(edges[lo:hi + 1]))
                full, is_hot = _rolled(h, window), crowded.has(anchor.view(_U))
                spread = np.repeat(np.flatnonzero(is_hot), n[is_hot])      # each window of a hot anchor on its own
                step = np.arange(len(spread)) - np.repeat(np.append(0, np.cumsum(n[is_hot]))[:-1], n[is_hot])
                place = begin[of] + first
                shard = np.concatenate((anchor[~is_hot], full[place[spread] + step].view(np.int64)))
                at = np.concatenate((first[~is_hot], first[spread] + step))
                size = np.concatenate((n[~is_hot], np.ones(len(spread), np.int64))) + (window - 1)
                of = np.concatenate((of[~is_hot], of[spread]))
                w = begin[of] + at
                data = raw[own[0]:own[-1]].tobytes()
                texts = pa.array([data[x:y] for x, y in zip(start[w].tolist(), end[w + size - 1].tolist())], pa.binary())
                rows = pa.array(of + lo)
                yield _earliest(pa.RecordBatch.from_arrays([
                    pa.array(shard), b.column(0).take(rows), b.column(1).take(rows), pa.array(at), texts], schema=_PIECE_ARROW))

    return arrow_map(marked.filter(F.size("start") > 0).select("doc_id", "tie", "words", "start", "n", "h"), run, _PIECE)


def _earliest(b: pa.RecordBatch) -> pa.RecordBatch:
    """Of equal texts, the row with the earliest place."""
    code = b.column(4).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    ids = b.column(1)
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    order = np.lexsort((b.column(3).to_numpy(), b.column(2).to_numpy(zero_copy_only=False),
                        ids.fill_null(0).to_numpy(zero_copy_only=False), known, code))
    new = np.ones(len(order), bool)
    new[1:] = code[order][1:] != code[order][:-1]
    return b.take(pa.array(order[new]))


class SuffixAutomaton:
    """States of all substrings of the texts added so far; ``ended`` is where a state's substrings
    end first (text number << 32 | words up to there), given texts in ascending order."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ended = [-1], [0], [0]

    def add(self, words: list[int], text: int) -> None:
        last = 0
        for i, t in enumerate(words, 1):
            last = self._extend(last, t, text << 32 | i)

    def _extend(self, last: int, t: int, at: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(t)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, t, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        self.ended.append(at)
        p = last
        while p != -1 and t not in nxt[p]:
            nxt[p][t] = new
            p = link[p]
        if p != -1:
            q = nxt[p][t]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, t, q)
        return new

    def _clone(self, p: int, t: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        c = len(nxt)
        nxt.append(nxt[q].copy())
        length.append(length[p] + 1)
        link.append(link[q])
        self.ended.append(self.ended[q])
        link[q] = c
        while p != -1 and nxt[p].get(t) == q:
            nxt[p][t] = c
            p = link[p]
        return c

    def repeats(self, words: list[int], window: int) -> Iterator[tuple[int, int]]:
        """Matching statistics of a text: (words up to here, where the match of ``window`` words that
        ends here ended first), wherever the longest match has that many."""
        nxt, link, length, ended = self.next, self.link, self.length, self.ended
        s = n = 0
        for i, t in enumerate(words, 1):
            while t not in nxt[s] and s:
                s = link[s]
                n = length[s]
            s = nxt[s].get(t, 0)
            n = n + 1 if s else 0
            if n >= window:
                while length[link[s]] >= window:        # the state of the last ``window`` words alone
                    s = link[s]
                n = min(n, length[s])
                yield i, ended[s]


_FIRST = T.StructType(_KEY + [T.StructField("start", T.LongType()), T.StructField("n", T.LongType())])


def _first_windows(texts: dict[bytes, tuple], window: int) -> Iterator[tuple]:
    """(doc_id, tie, start, n): runs of windows of a shard that occur nowhere earlier in it."""
    order = sorted(texts.items(), key=lambda x: x[1])
    vocab: dict[bytes, int] = {}
    coded = [[vocab.setdefault(w, len(vocab)) for w in t.split(b" ")] for t, _ in order]
    automaton = SuffixAutomaton()
    for k, ws in enumerate(coded):
        automaton.add(ws, k)
    for k, ws in enumerate(coded):
        (_, doc_id, tie, at), run = order[k][1], None
        for i, ended in automaton.repeats(ws, window):
            if ended == k << 32 | i:
                if run and run[1] == i - 1:
                    run[1] = i
                else:
                    if run:
                        yield doc_id, tie, at + run[0] - window, run[1] - run[0] + 1
                    run = [i, i]
        if run:
            yield doc_id, tie, at + run[0] - window, run[1] - run[0] + 1


def _shards(pieces: DataFrame, window: int) -> DataFrame:
    """First windows of all shards; the pieces of a partition come sorted by shard."""
    def flush(texts: dict) -> Iterator[pa.RecordBatch]:
        rows = list(zip(*_first_windows({t: (p[0] is not None, p[0], p[1], p[2]) if p[0] is not None else (False, None, p[1], p[2])
                                         for t, p in texts.items()}, window)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], names=_FIRST.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[bytes, tuple] = {}
        held, last = 0, None
        for b in batches:
            for shard, doc_id, tie, at, text in zip(*[c.to_pylist() for c in b.columns]):
                if shard != last and held >= SHARD_WORDS:
                    yield from flush(texts)
                    texts, held = {}, 0
                last = shard
                was = texts.get(text)
                if was is None:
                    texts[text] = (doc_id, tie, at)
                    held += text.count(b" ") + 1
                elif _before((doc_id, tie, at), was):
                    texts[text] = (doc_id, tie, at)
        yield from flush(texts)

    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return arrow_map(pieces.repartition(parts, "shard").sortWithinPartitions("shard"), run, _FIRST)


def _before(a: tuple, b: tuple) -> bool:
    if a[0] is None or b[0] is None:
        return (a[0] is not None, a[1:]) < (b[0] is not None, b[1:])
    return a < b


_KEPT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                      T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])


def _without(marked: DataFrame, window: int) -> DataFrame:
    """The words that no repeated window covers; ``firsts`` are the marked windows that are none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(lo, 512) for whole in batches for lo in range(0, whole.num_rows, 512)):
            _, sizes, texts, starts, ns, firsts = [c.to_pylist() for c in b.columns]
            removed, kept = [], []
            for size, text, start, n, first in zip(sizes, texts, starts, ns, firsts):
                repeats = np.zeros(size + 1, bool)
                for s, k in zip(start, n):
                    repeats[s:s + k] = True
                for f in first or ():
                    repeats[f["start"]:f["start"] + f["n"]] = False
                at = np.flatnonzero(repeats)
                cover = np.zeros(size + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + window, -1)
                gone = np.cumsum(cover)[:size] > 0
                removed.append(int(gone.sum()))
                kept.append(" ".join([w for w, g in zip(text.split(" "), gone.tolist()) if not g]) if removed[-1] else text)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             names=_KEPT.fieldNames())
    return arrow_map(marked.select("doc_id", "n_words", "words", "start", "n", "firsts"), run, _KEPT)


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, one space between) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tie"),
                       F.col(text_col).alias("text"))
    counts = stage(_anchor_counts(rows.select("text").filter("text IS NOT NULL"), window).filter("n > 1"), "anchors")
    n = counts.agg(F.count(F.lit(1)), F.count(F.when(F.col("n") >= HOT, 1))).first()
    marked = stage(_marked(rows, window, build(counts.select("h"), n[0])), "stretches", compression="zstd")
    firsts = _shards(_pieces(marked, window, build(counts.filter(F.col("n") >= HOT).select("h"), n[1])), window)
    firsts = firsts.distinct().groupBy("doc_id", "tie").agg(F.collect_list(F.struct("start", "n")).alias("firsts"))
    whole = marked.filter(F.size("start") == 0).select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"),
                                                       F.col("words").alias("kept"))
    part = marked.filter(F.size("start") > 0).alias("m").join(
        firsts.alias("f"), F.expr("m.doc_id <=> f.doc_id AND m.tie = f.tie"), "left").select("m.*", "f.firsts")
    return whole.union(_without(part, window))
