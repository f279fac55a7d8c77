"""Benchmark decontamination with a generalised suffix automaton.

The automaton of all normalised benchmark items is built once per run and broadcast; every
document's words stream through it, tracking the longest match that ends at each word.  A match
of ``window`` words, or of a whole shorter item, marks its words as hit.  Documents are never
shuffled.  A word outside the benchmark's vocabulary resets the automaton, so only runs of known
words are streamed.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters from U+0080 on.

Items are dealt by hash to groups of about ``GROUP_CHARS`` characters, one automaton each.  With one
group the documents stream through once.  With more, there is a pass over the documents for every
group, so that the driver, a broadcast and a Python worker hold one group at a time, whatever the size
of the benchmark; the hits of the passes, rows of documents that are hit, are put together by
document.  An item of more than ``ITEM_CHARS`` characters is refused.

Cases: null and empty texts have no words and are never hit; an item without words has no
window; repeated items count once per item id; an empty benchmark hits nothing; other columns
are ignored (reports) or passed through (cleaning).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumshift.llm.rows import per_text, rewrite_text
from forumshift.llm.shipping import arrow_map
from forumshift.llm.staging import stage

GROUP_CHARS = ITEM_CHARS = 2_000_000        # about 140 MB of automaton
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
_WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class SuffixAutomaton:
    """States of all substrings of the items; ``step`` follows a word, falling back along suffix
    links, and keeps the length of the longest match."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        paths = []
        for item, ws in items:
            last, path = 0, []
            for w in ws:
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
                path.append(last)
            if ws:
                paths.append((item, ws))
        self._mark(paths)

    def _extend(self, last: int, t: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if t in nxt[last]:
            q = nxt[last][t]
            return q if length[q] == length[last] + 1 else self._clone(last, t, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
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
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = c
        while p != -1 and nxt[p].get(t) == q:
            nxt[p][t] = c
            p = link[p]
        return c

    def _mark(self, paths: list[tuple[str, list[bytes]]]) -> None:
        """Which items have a window ending in a state: whole windows and whole short items."""
        n, w = len(self.next), self.window
        self.holder = [-1] * n                       # the state of a match's last `window` words
        for s in sorted(range(n), key=self.length.__getitem__):
            if self.length[s] >= w:
                p = self.link[s]
                self.holder[s] = self.holder[p] if self.length[p] >= w else s
        self.items: dict[int, set[str]] = {}
        own: dict[int, list[tuple[int, str]]] = {}
        self.shortest = w
        for item, ws in paths:
            s = 0
            for t in map(self.vocab.__getitem__, ws):
                s = self.next[s][t]
                if self.holder[s] >= 0:
                    self.items.setdefault(self.holder[s], set()).add(item)
            if len(ws) < w:
                self.shortest = min(self.shortest, len(ws))
                while self.length[self.link[s]] >= len(ws):
                    s = self.link[s]
                own.setdefault(s, []).append((len(ws), item))
        self.shorts: list[tuple] = [()] * n          # short items that are suffixes of a match
        if own:
            for s in sorted(range(n), key=self.length.__getitem__):
                up = self.shorts[self.link[s]] if s else ()
                self.shorts[s] = up + tuple(own[s]) if s in own else up

    def scan(self, ws: list[bytes]) -> tuple[list[tuple[int, int, int, bool]], set[str]]:
        """([(first hit word, end, longest match in it, whether it holds a whole short item)], items):
        maximal runs of hit words."""
        spans: list[list[int]] = []
        found: set[str] = set()
        if not self.vocab or len(ws) < self.shortest:
            return spans, found
        ids = np.fromiter(map(self.vocab.get, ws, repeat(-1)), np.int32, len(ws))
        edge = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).view(np.int8)))
        for a, b in edge.reshape(-1, 2)[np.diff(edge)[::2] >= self.shortest].tolist():
            self._run(a, ids[a:b].tolist(), spans, found)
        return [tuple(x) for x in spans], found

    def _run(self, at: int, ids: list[int], spans: list[list[int]], found: set[str]) -> None:
        nxt, link, length, w, shorts = self.next, self.link, self.length, self.window, self.shorts
        s = n = 0
        for i, t in enumerate(ids, at + 1):
            while t not in nxt[s] and s:
                s = link[s]
                n = length[s]
            s = nxt[s].get(t, 0)
            n = n + 1 if s else 0
            size, whole = 0, False
            if n >= w:
                size = w
                found |= self.items[self.holder[s]]
            if shorts[s]:
                for k, item in shorts[s]:
                    if k <= n:
                        size, whole = max(size, k), True
                        found.add(item)
            if size:
                if spans and spans[-1][1] >= i - size:
                    spans[-1][1], spans[-1][2] = i, max(spans[-1][2], n)
                    spans[-1][0] = min(spans[-1][0], i - size)
                    spans[-1][3] |= whole
                else:
                    spans.append([i - size, i, n, whole])
                while len(spans) > 1 and spans[-2][1] >= spans[-1][0]:
                    a, b, k, whole = spans.pop()
                    last = spans[-1]
                    spans[-1] = [min(last[0], a), max(last[1], b), max(last[2], k), last[3] or whole]


def automata(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text"):
    """Broadcasts of the benchmark's groups, one after the other; each is to be dropped before the next."""
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).filter("t IS NOT NULL")
    size, longest = items.agg(F.sum(F.length("t")), F.max(F.length("t"))).first()
    if (longest or 0) > ITEM_CHARS:
        raise ValueError(f"an item of {longest} characters; at most {ITEM_CHARS} are supported")
    groups = max(1, -(-(size or 0) // GROUP_CHARS))
    sc = benchmark.sparkSession.sparkContext
    for g in range(groups):
        own = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(groups)) == g)
        rows = sorted({(r.i or "", r.t) for r in own.toLocalIterator()})
        yield g, groups, sc.broadcast((uuid.uuid4().hex, [(i, words_of(t)) for i, t in rows]))


_BUILT: dict = {}


def _scanner(shared, window: int):
    """The scan of one group, whose automaton is built once per Python worker and replaces the last."""
    key, items = shared.value
    if (key, window) not in _BUILT:
        _BUILT.clear()
        _BUILT[key, window] = SuffixAutomaton(items, window)
    return _BUILT[key, window].scan


def _merged(spans):
    out = []
    for a, b, n, whole in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(b, out[-1][1]), max(n, out[-1][2]), out[-1][3] or whole)
        else:
            out.append((a, b, n, whole))
    return out


_HITS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("tie", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                                                     T.StructField("n", T.LongType()), T.StructField("whole", T.BooleanType())]))),
    T.StructField("items", T.ArrayType(T.StringType()))])
_HITS_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("tie", pa.int64()),
    ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("whole", pa.bool_())]))),
    ("items", pa.list_(pa.string()))])


def _hits(docs: DataFrame, shared, window: int) -> DataFrame:
    """(doc_id, tie, spans, items) of the rows (doc_id, tie, text) that one group hits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(shared, window)
        for b in batches:
            out = []
            for doc_id, tie, text in zip(*[c.to_pylist() for c in b.columns]):
                spans, found = scan(words_of(text))
                if spans:
                    out.append((doc_id, tie, [dict(zip("a b n whole".split(), s)) for s in spans], sorted(found)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _HITS_ARROW)], schema=_HITS_ARROW)
    return arrow_map(docs, run, _HITS)


def _all_hits(docs: DataFrame, first, rest, window: int) -> DataFrame:
    """The hits of all groups, a staged pass each, by (doc_id, tie): rows equal in both are one text."""
    passes = []
    for _, _, shared in chain([first], rest):
        passes.append(stage(_hits(docs, shared, window), "benchmark-hits"))
        shared.destroy()
    every = reduce(DataFrame.union, passes)
    return every.groupBy("doc_id", "tie").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
                                              F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tie"),
                       F.col(text_col).alias("text"))


def _with_hits(rows: DataFrame, hits: DataFrame) -> DataFrame:
    return rows.alias("r").join(hits.alias("h"), F.expr("r.doc_id <=> h.doc_id AND r.tie = h.tie"), "left").select(
        "r.*", "h.spans", "h.items")


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, longest (longest match in words), items (sorted ids) per document."""
    groups = automata(benchmark, window)
    first = next(groups)
    fields = [("n_words", pa.int64(), T.LongType()), ("n_hit", pa.int64(), T.LongType()),
              ("longest", pa.int64(), T.LongType()), ("items", pa.list_(pa.string()), T.ArrayType(T.StringType()))]
    if first[1] == 1:
        shared = first[2]

        def make():
            scan = _scanner(shared, window)

            def one(text: str) -> tuple:
                ws = words_of(text)
                spans, found = scan(ws)
                return (len(ws), sum(x[1] - x[0] for x in spans), max((x[2] for x in spans), default=0), sorted(found))
            return one

        return per_text(docs, id_col, text_col, fields, make)

    keyed = _keyed(docs, id_col, text_col)
    hits = _all_hits(keyed, first, groups, window)

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(words_of(t)) for t in b.column(2).to_pylist()],
                                                                                pa.int64())], names=["doc_id", "tie", "n_words"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [_merged([tuple(s.values()) for s in x or ()]) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([sum(s[1] - s[0] for s in x) for x in spans], pa.int64()),
                pa.array([max((s[2] for s in x), default=0) for x in spans], pa.int64()),
                pa.array([x or [] for x in b.column(3).to_pylist()], pa.list_(pa.string()))],
                names=["doc_id", "n_words", "n_hit", "longest", "items"])

    sizes = arrow_map(keyed, size, "doc_id long, tie long, n_words long")
    out = T.StructType([T.StructField("doc_id", T.LongType())] + [T.StructField(n, t) for n, _, t in fields])
    return arrow_map(_with_hits(sizes, hits).select("doc_id", "n_words", "spans", "items"), summed, out)


def _cleaned(text: str, ws: list[bytes], spans: list, max_match: int, max_coverage: float) -> str | None:
    spans = [x for x in spans if x[2] >= max_match or x[3]]
    if not spans:
        return text
    if sum(x[1] - x[0] for x in spans) > max_coverage * len(ws):
        return None
    at = [m.span() for m in _WORD.finditer(text)]
    out, done = [], 0
    for a, b, *_ in spans:
        out.append(text[done:at[a][0]])
        done = at[b - 1][1]
    return "".join(out) + text[done:]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_match: int = 10,
                  max_coverage: float = 0.8, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without benchmark text: hit spans whose longest match reaches ``max_match`` words
    or that hold a whole item shorter than the window are cut out, and documents of which more than ``max_coverage`` of
    the words are hit are dropped."""
    groups = automata(benchmark, window)
    first = next(groups)
    if first[1] == 1:
        shared = first[2]

        def make():
            scan = _scanner(shared, window)

            def one(text: str | None) -> str | None:
                ws = words_of(text)
                return _cleaned(text, ws, scan(ws)[0], max_match, max_coverage)
            return one

        return rewrite_text(docs, text_col, make)

    hits = _all_hits(_keyed(docs, id_col, text_col), first, groups, window).select(
        F.col("doc_id").alias("_hit_id"), F.col("tie").alias("_hit_tie"), F.col("spans").alias("_hit_spans"))
    found = docs.join(hits, F.col(id_col).cast("long").eqNullSafe(F.col("_hit_id")) & (F.xxhash64(text_col) == F.col("_hit_tie")), "left")
    found = found.drop("_hit_id", "_hit_tie")
    at, text_at = found.columns.index("_hit_spans"), found.columns.index(text_col)
    names = docs.columns
    count = names.index("n_chars") if "n_chars" in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = [i for i, x in enumerate(b.column(at).to_pylist()) if x]
            texts, gone = b.column(text_at).to_pylist(), set()
            for i in hit:
                spans = _merged([tuple(s.values()) for s in b.column(at)[i].as_py()])
                texts[i] = _cleaned(texts[i], words_of(texts[i]), spans, max_match, max_coverage)
                if texts[i] is None:
                    gone.add(i)
            keep = pa.array([i for i in range(b.num_rows) if i not in gone], pa.int64())
            cols = [c.take(keep) for k, c in enumerate(b.columns) if k != at]
            own = [texts[i] for i in keep.to_pylist()]
            cols[names.index(text_col)] = pa.array(own, b.column(text_at).type)
            if count is not None:
                cols[count] = pa.array([None if t is None else len(t) for t in own], cols[count].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return arrow_map(found, cut, docs.schema)
