"""Embedding near-dedup by int8 tile products with rigorous error bounds.

Every vector is normalised in double precision and quantised to int8 with its own scale s; the
remainder e = x - s q is known exactly enough to bound every product:
|x.y - s_x s_y q_x.q_y| <= |s_x q_x| |e_y| + |e_x| |s_y q_y| + |e_x| |e_y|.  Tiles of
``TILE`` by ``TILE`` vectors multiply the int8 parts (integers, exact in single precision up to
``EXACT_DIM`` components, in double beyond).  A pair whose lower bound reaches the threshold is a
link; one whose bounds lie around it is open, and a second pass over the tile recomputes the open
pairs in double precision, from the full vectors of those that take part in one.

Identical vectors form a class first and only classes meet, so copies are never paired.  All
classes are compared, in blocks; a tile returns link counts per class and a spanning forest of
its links, never the pairs.  The work is quadratic in the number of distinct vectors, in tasks of
bounded size.

Cases: null, zero, empty or non-finite vectors link with nothing; vectors of different lengths
do not link; repeated rows and ties belong to one class; null ids count as links but never name
a component that has another id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumshift.llm.components import components, name_components, star
from forumshift.llm.shipping import arrow_map
from forumshift.llm.staging import stage

TILE, EXACT_DIM = 4096, 1040
MOST_TASKS = 20_000
_ROWS = 512                    # rows of a tile multiplied at a time
_SLACK = 1e-5                  # above the single-precision error of scaling a product

_PARTS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("cls", T.BinaryType()), T.StructField("dim", T.LongType()),
    T.StructField("q", T.BinaryType()), T.StructField("scale", T.DoubleType()), T.StructField("err", T.DoubleType()),
    T.StructField("full", T.BinaryType())])


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, scale, err) of unit rows: x = scale * q + e with |e| <= err."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    err = np.linalg.norm(x - scale[:, None] * q, axis=1)
    return q, scale, err * (1 + 1e-9) + 1e-12


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("vec_id", pa.int64()), ("cls", pa.binary()), ("dim", pa.int64()), ("q", pa.binary()),
                        ("scale", pa.float64()), ("err", pa.float64()), ("full", pa.binary())])
    for b in batches:
        rows = []
        for v, x in zip(b.column(0).to_pylist(), b.column(1)):
            x = np.zeros(0) if not x.is_valid else np.array(x.values.to_numpy(zero_copy_only=False))
            wide = x.astype(np.float64)
            norm = np.linalg.norm(wide) if len(wide) and np.isfinite(wide).all() else 0.0
            if norm == np.inf:
                wide = wide / np.abs(wide).max()
                norm = np.linalg.norm(wide)
            if not norm > 0:
                rows.append((v, None, 0, None, 0.0, 0.0, None))
                continue
            x = x + x.dtype.type(0)                       # -0.0 is 0.0
            q, scale, err = quantise((wide / norm)[None, :])
            rows.append((v, hashlib.blake2b(x.tobytes(), digest_size=16).digest(), len(x), q.tobytes(),
                         float(scale[0]), float(err[0]), x.tobytes()))
        cols = list(zip(*rows)) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


class _Side:
    """The vectors of one side of a tile; ``full`` only where the table has them."""

    def __init__(self, t: pa.Table, kind: str, dim: int):
        self.cls = t.column("cls").to_pylist()
        self.copies = t.column("copies").to_numpy().astype(np.float64)
        self.q = np.frombuffer(b"".join(t.column("q").to_pylist()), np.int8).reshape(-1, dim)
        self.q = self.q.astype(np.float32 if dim <= EXACT_DIM else np.float64)
        self.scale, self.err = t.column("scale").to_numpy(), t.column("err").to_numpy()
        self.size = self.scale * np.sqrt((self.q.astype(np.float64) ** 2).sum(axis=1))
        if "full" in t.column_names:
            full = np.frombuffer(b"".join(t.column("full").to_pylist()), kind).reshape(-1, dim).astype(np.float64)
            top = np.abs(full).max(axis=1, keepdims=True)
            full = np.where(np.isfinite(np.linalg.norm(full, axis=1, keepdims=True)), full, full / top)
            self.full = full / np.linalg.norm(full, axis=1, keepdims=True)


def _bounded(one: _Side, two: _Side, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(i, j) of the pairs whose bounds lie above the threshold, and of those around it."""
    sure, open_ = [], []
    for lo in range(0, len(one.scale), _ROWS):
        r = slice(lo, lo + _ROWS)
        dot = one.q[r] @ two.q.T
        dot *= one.scale[r, None].astype(dot.dtype)
        dot *= two.scale[None, :].astype(dot.dtype)
        loose = one.size[r] * two.err.max() + one.err[r] * two.size.max() + one.err[r] * two.err.max()
        i, j = np.nonzero(dot >= (threshold - _SLACK - loose)[:, None].astype(dot.dtype))
        near = dot[i, j].astype(np.float64)
        i = i + lo
        if same:
            near, i, j = near[i != j], i[i != j], j[i != j]
        bound = one.size[i] * two.err[j] + one.err[i] * two.size[j] + one.err[i] * two.err[j]
        above = near - bound >= threshold + _SLACK
        around = ~above & (near + bound >= threshold - _SLACK)
        sure.append(np.stack([i[above], j[above]]))
        open_.append(np.stack([i[around], j[around]]))
    (si, sj), (oi, oj) = [np.concatenate(x, axis=1) if x else np.zeros((2, 0), np.int64) for x in (sure, open_)]
    return si, sj, oi, oj


_FOUND = "u binary, v binary, n long, open boolean, is_left boolean, dim long, i long, j long"


def _tile(threshold: float, kind: str, exact: bool):
    """The links of a tile as counts and a forest.  From the int8 parts come the links that the bounds
    prove, and the vectors that take part in a pair they leave open; ``exact`` is for a tile of such
    vectors alone, in full, and gives the links among the open pairs."""
    def run(tile: pa.Table) -> pa.Table:
        left = tile.column("is_left").to_numpy(zero_copy_only=False).astype(bool)
        dim, at_i, at_j = [tile.column(c)[0].as_py() for c in ("dim", "i", "j")]
        same = at_i == at_j
        one = _Side(tile.filter(pa.array(left)), kind, dim)
        two = one if same else _Side(tile.filter(pa.array(~left)), kind, dim)
        rows: list[tuple] = []
        if len(one.cls) and len(two.cls):
            i, j, oi, oj = _bounded(one, two, threshold, same)
            if exact:
                kept = [(oi[k:k + (1 << 16)], oj[k:k + (1 << 16)]) for k in range(0, len(oi), 1 << 16)]
                kept = [(a[s], b[s]) for a, b in kept
                        for s in [np.einsum("ij,ij->i", one.full[a], two.full[b]) >= threshold]]
                i = np.concatenate([a for a, _ in kept]) if kept else oi[:0]
                j = np.concatenate([b for _, b in kept]) if kept else oj[:0]
            n = len(one.cls)
            names = one.cls if same else one.cls + two.cls
            count = np.bincount(i, weights=two.copies[j], minlength=len(names))
            if not same:
                count += np.bincount(j + n, weights=one.copies[i], minlength=len(names))
            low = star(i, j if same else j + n, len(names))
            rows = [(names[k], names[low[k]], int(count[k]), False, True) for k in np.flatnonzero(count)]
            if not exact:
                rows += [(one.cls[k], None, 0, True, True) for k in np.unique(oi)]
                rows += [] if same else [(two.cls[k], None, 0, True, False) for k in np.unique(oj)]
        cols = list(zip(*rows)) or [()] * 5
        kinds = (pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.bool_())
        place = [pa.array([x] * len(rows), pa.int64()) for x in (dim, at_i, at_j)]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)] + place,
                        names=["u", "v", "n", "open", "is_left", "dim", "i", "j"])
    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row; cosine >= ``threshold`` links."""
    element = vectors.schema[vector_col].dataType.elementType
    if not isinstance(element, T.FloatType):
        vectors = vectors.withColumn(vector_col, F.col(vector_col).cast("array<double>"))
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
    rows = stage(arrow_map(rows, _quantised, _PARTS), "vectors")
    classes = stage(rows.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"),
        *(F.first(c).alias(c) for c in ("dim", "q", "scale", "err", "full"))), "vector-classes")
    sizes = classes.groupBy("dim").agg(F.ceil(F.count("*") / TILE).alias("blocks"))
    dealt = classes.drop("vec_id").join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("cls"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("o")
    tiles = dealt.select("*", other).select(
        "dim", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"),
        (F.col("block") <= F.col("o")).alias("is_left"), "cls", "copies", "q", "scale", "err")
    # as many partitions as tiles, whatever their bytes: the work is in the products
    n = int(sizes.agg(F.sum(F.col("blocks") * (F.col("blocks") + 1) / 2)).first()[0] or 1)

    def products(rows: DataFrame, exact: bool) -> DataFrame:
        dealt = rows.repartition(min(4 * n, MOST_TASKS), "dim", "i", "j")
        return stage(dealt.groupBy("dim", "i", "j").applyInArrow(_tile(threshold, kind, exact), _FOUND), "vector-links")

    proven = products(tiles, exact=False)
    # full vectors go only where a pair is open, and only those of its vectors
    doubtful = proven.filter("open").select("dim", "i", "j", "is_left", F.col("u").alias("cls"))
    full = classes.select("cls", "copies", "q", "scale", "err", "full")
    found = proven.filter("NOT open").union(products(doubtful.join(full, "cls"), exact=True))
    roots = components(found.select("u", "v"), "vector")
    counts = found.groupBy("u").agg(F.sum("n").alias("n")).withColumnRenamed("u", "cls")
    named = (classes.select("cls", "copies").join(counts, "cls", "left")
             .join(name_components(classes, roots, "vec_id"), "cls"))
    out = rows.select("vec_id", "cls").join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", (F.coalesce("n", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
