"""Packing documents into fixed windows by non-negative least squares.

Every task tokenises its documents and packs them block by block (``BLOCK_TOKENS`` ids), so
memory does not follow the input and nothing is shuffled.  In a block:

1. whole windows are cut off long documents;
2. the remaining pieces are binned by length, and all combinations of at most ``DEPTH`` bins
   that fill a window are enumerated; non-negative least squares finds how often to repeat each
   so that their lengths add up to the histogram;
3. the counts are rounded down and the combinations filled with pieces;
4. the residual pieces are packed greedily, cut where a window is full: first into what the
   combinations left open, then into windows of their own.

What does not fill a window goes on to the next block; at the end of a task it is cut into
sequences of power-of-two lengths, which need no padding.

Cases: a null or empty text is the end id alone; repeated rows are packed as often as they
occur; null ids pass through; an empty table packs nothing; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumshift.llm.shipping import arrow_map
from forumshift.llm.tokens import encoder, vocabulary

WINDOW, BINS, DEPTH = 4096, 64, 4
BLOCK_TOKENS = 6_000_000


@lru_cache(maxsize=4)
def combinations(bins: int, depth: int) -> np.ndarray:
    """(bins, patterns): how often each bin (of 1..bins units) occurs in every combination of at
    most ``depth`` bins that adds up to ``bins`` units."""
    found: list[list[int]] = []

    def extend(parts: list[int], left: int, most: int) -> None:
        if not left:
            found.append(parts)
        elif len(parts) < depth:
            for k in range(min(left, most), 0, -1):
                if k * (depth - len(parts)) < left:
                    break
                extend([*parts, k], left - k, k)

    extend([], bins, bins)
    a = np.zeros((bins, len(found)))
    for j, parts in enumerate(found):
        for k in parts:
            a[k - 1, j] += 1
    return a


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 minimising |a x - b| (active sets: Lawson and Hanson)."""
    gram, target = a.T @ a, a.T @ b
    x = np.zeros(a.shape[1])
    passive: list[int] = []
    tol = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(10 * a.shape[0]):
        w = target - gram[:, passive] @ x[passive] if passive else target.copy()
        w[passive] = -np.inf
        j = int(np.argmax(w))
        if w[j] <= tol:
            break
        passive.append(j)
        while passive:
            z = np.linalg.lstsq(gram[np.ix_(passive, passive)], target[passive], rcond=None)[0]
            if z.min() > 0:
                x[:] = 0
                x[passive] = z
                break
            old = x[passive]
            low = z <= 0
            step = np.min(old[low] / np.maximum(old[low] - z[low], 1e-300))
            x[passive] = old + step * (z - old)
            gone = {p for p in passive if x[p] <= 1e-12}
            if not gone:
                break
            x[list(gone)] = 0
            passive = [p for p in passive if p not in gone]
    return x


class Packer:
    """Takes (document, its start, ids) pieces; gives (document, start, ids, sequence, offset)."""

    def __init__(self, first_sequence: int, window: int = WINDOW):
        self.window, self.unit = window, max(1, window // BINS)
        self.bins = -(-window // self.unit)
        self.sequence = first_sequence
        self.pool: list[tuple[int, int, np.ndarray]] = []
        self.tokens = 0

    def _sequence(self, pieces: list) -> Iterator[tuple]:
        at = 0
        for doc, start, ids in pieces:
            yield doc, start, ids, self.sequence, at
            at += len(ids)
        self.sequence += 1

    def add(self, doc: int, ids: np.ndarray) -> Iterator[tuple]:
        whole = len(ids) - len(ids) % self.window
        for start in range(0, whole, self.window):
            yield from self._sequence([(doc, start, ids[start:start + self.window])])
        if whole < len(ids):
            self.pool.append((doc, whole, ids[whole:]))
            self.tokens += len(ids) - whole
            if self.tokens >= BLOCK_TOKENS:
                yield from self._block()

    def _block(self) -> Iterator[tuple]:
        by_bin: list[list] = [[] for _ in range(self.bins)]
        for piece in self.pool:
            by_bin[-(-len(piece[2]) // self.unit) - 1].append(piece)
        patterns = combinations(self.bins, DEPTH)
        counts = np.floor(nnls(patterns, np.array([len(x) for x in by_bin], float)) + 1e-6).astype(int)
        made = []
        for j in np.flatnonzero(counts):
            need = patterns[:, j].astype(int)
            bins = np.flatnonzero(need)
            times = min([int(counts[j]), *(len(by_bin[k]) // need[k] for k in bins)])
            for _ in range(times):
                pieces = [by_bin[k].pop() for k in bins for _ in range(need[k])]
                made.append((self.window - sum(len(p[2]) for p in pieces), pieces))
        rest = [p for x in by_bin for p in x]
        spare, open_ = sum(len(p[2]) for p in rest), sum(s for s, _ in made)
        made.sort(key=lambda m: m[0])
        while made and spare < open_:                # too little is left to close the widest gaps
            gap, pieces = made.pop()
            rest += pieces
            spare += self.window - gap
            open_ -= gap
        queue = deque(sorted(rest, key=lambda p: -len(p[2])))
        for gap, pieces in made:
            yield from self._sequence(pieces + self._take(queue, gap))
            spare -= gap
        while spare >= self.window:
            yield from self._sequence(self._take(queue, self.window))
            spare -= self.window
        self.pool, self.tokens = list(queue), spare

    @staticmethod
    def _take(queue: deque, n: int) -> list:
        """Pieces of exactly ``n`` ids from the queue, the last one cut."""
        out = []
        while n:
            doc, start, ids = queue.popleft()
            if len(ids) > n:
                queue.appendleft((doc, start + n, ids[n:]))
                ids = ids[:n]
            out.append((doc, start, ids))
            n -= len(ids)
        return out

    def close(self) -> Iterator[tuple]:
        yield from self._block()
        queue = deque(self.pool)
        for k in reversed(range(self.window.bit_length())):
            if self.tokens >> k & 1:
                yield from self._sequence(self._take(queue, 1 << k))
        self.pool, self.tokens = [], 0


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    with ``keep_ids`` the piece's ids (little-endian, of the narrowest type that holds the
    vocabulary).  ``tokenizer`` is the path of a vocabulary file; every document ends with
    ``end_id``.  Sequence ids are unique, and ascending within a task."""
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary(tokenizer))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                        ("offset", pa.int64())] + ([("ids", pa.binary())] if keep_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(spec.value, end_id)
        packer = Packer(TaskContext.get().partitionId() << 40, window)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = [list(c) for c in zip(*rows)] or [[]] * len(schema)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        def keep(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            for (doc, total), start, ids, sequence, at in pieces:
                row = (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, at)
                rows.append((*row, ids.tobytes()) if keep_ids else row)
                if len(rows) >= 2000:
                    yield batch()

        for b in batches:
            names = b.column(0).to_pylist()
            for doc, raw in zip(names, enc.encode(b.column(1))):
                ids = np.frombuffer(raw, enc.dtype)
                yield from keep(packer.add((doc, len(ids)), ids))
        yield from keep(packer.close())
        yield batch()

    fields = {"ids": T.BinaryType()}
    out = T.StructType([T.StructField(f.name, fields.get(f.name, T.LongType())) for f in schema])
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(texts, run, out)
