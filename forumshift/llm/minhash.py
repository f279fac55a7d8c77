"""MinHash near-dedup by min-max hashing.

Every permutation of the shingle hashes keeps both its minimum and its maximum, so N
permutations give 2N signature values.  Bands of ``ROWS`` values are bucket keys.  The stages:

1. one pass over the texts: shingle-set digest, band keys and a one-bit sketch per row;
2. rows with equal sets form a class (a third of all rows may be one class: it is a map-side
   combined ``min``), only classes go on;
3. star round: in each bucket every class is paired with the bucket's centre (another one in
   each band); pairs that pass size and sketch bounds are confirmed on their full sets;
4. rest round: where a bucket still holds several components, its members outside the largest
   one meet the members of all buckets with that component, in blocks of bounded size; a block
   returns a spanning forest of the links it confirms;
5. components over the confirmed links.

The bands miss a pair of similarity s with probability (1 - s**ROWS)**BANDS, 3.2e-6 at s = 0.8.
The sketch bound lies seven standard deviations below the threshold and adds 2e-9 if the bits are
independent, so that a miss has probability 3.2e-6 in all.

Cases: null and blank texts have an empty set, link with nothing and are their own component;
repeated rows fall into one class; columns other than id and text are ignored; an empty table
gives an empty result; a null id never becomes a component id unless the whole component has
none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumshift.llm.components import components, hang, name_components, star
from forumshift.llm.shipping import arrow_map
from forumshift.llm.staging import stage
from forumshift.llm.wordhash import digest, mix, shingle_sets

BANDS, ROWS = 24, 4
PERMUTATIONS = BANDS * ROWS // 2
BLOCK = 256                      # members of a family compared at a time

_rng = np.random.default_rng(7919)
_MUL = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_ORDER = _rng.permutation(2 * PERMUTATIONS)      # which signature values share a band

_ROW, _SAID, _COPIES = "__minhash_row", "__minhash_said", "__minhash_copies"   # beside any column of the input

_SIGNED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()),
    T.StructField("said", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("cls", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
    T.StructField("sk0", T.LongType()), T.StructField("sk1", T.LongType())])


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum and maximum of every permutation for non-empty sets: (rows, 2 * PERMUTATIONS)."""
    at = np.cumsum([0] + [len(s) for s in sets])[:-1]
    x = np.concatenate(sets)
    out = np.empty((2 * PERMUTATIONS, len(sets)), dtype=np.uint64)
    y = np.empty_like(x)
    for k in range(PERMUTATIONS):
        np.multiply(x, _MUL[k], out=y)
        y += _ADD[k]
        out[2 * k] = np.minimum.reduceat(y, at)
        out[2 * k + 1] = np.maximum.reduceat(y, at)
    return np.ascontiguousarray(mix(out).T[:, _ORDER])


def _bands(sig: np.ndarray) -> np.ndarray:
    acc = np.zeros((len(sig), BANDS), dtype=np.uint64)
    for r in range(ROWS):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS])
    return acc.view(np.int64)


def _sketch(sig: np.ndarray) -> np.ndarray:
    bits = np.zeros((len(sig), 128), dtype=np.uint8)
    bits[:, :sig.shape[1]] = (sig >> np.uint64(33)) & np.uint64(1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64)


def _sign(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("said", pa.int64()), ("n_shingles", pa.int64()),
                        ("cls", pa.binary()), ("bands", pa.list_(pa.int64())), ("sk0", pa.int64()), ("sk1", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, sets in shingle_sets(b.column(3), width):
                n = len(sets)
                full = [i for i, s in enumerate(sets) if len(s)]
                at = np.zeros(n + 1, np.int32)
                at[1:] = np.cumsum([BANDS if len(s) else 0 for s in sets])
                keys, sk = np.zeros(0, np.int64), np.zeros((n, 2), np.int64)
                if full:
                    sig = _signatures([sets[i] for i in full])
                    keys, sk[full] = _bands(sig).ravel(), _sketch(sig)
                yield pa.RecordBatch.from_arrays([
                    *(b.column(k).slice(lo, n) for k in range(3)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(keys)),
                    pa.array(sk[:, 0]), pa.array(sk[:, 1])], schema=schema)
    return run


def _sets(width: int):
    """The shingle set of each wanted class, once per task however often its row repeats."""
    schema = pa.schema([("cls", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[bytes] = set()
        for b in batches:
            wanted = b.column(0).to_pylist()
            for lo, sets in shingle_sets(b.column(1), width):
                found = []
                for cls, s in zip(wanted[lo:], sets):
                    if cls not in given and digest(s) == cls:
                        given.add(cls)
                        found.append((cls, s))
                if found:
                    at = np.cumsum([0] + [len(s) for _, s in found]).astype(np.int32)
                    flat = np.concatenate([s for _, s in found]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([c for c, _ in found], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], schema=schema)
    return run


def _most_differing(percent: int) -> int:
    """Sketch bits in which a linked pair may differ: seven standard deviations above the mean."""
    agree, bits = (1 + percent / 100) / 2, 2 * PERMUTATIONS
    return int(bits * (1 - agree) + 7 * math.sqrt(bits * agree * (1 - agree)))


def _plausible(percent: int):
    """Bounds a pair must pass before its sets are read: exact on sizes, seven sigma on sketches."""
    differ = F.bit_count(F.col("sk0").bitwiseXOR(F.col("o_sk0"))) + F.bit_count(
        F.col("sk1").bitwiseXOR(F.col("o_sk1")))
    small, large = F.least("n", "o_n"), F.greatest("n", "o_n")
    return (100 * small >= percent * large) & (differ <= _most_differing(percent))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose full shingle sets have 100 * intersection >= percent * union."""
    one = sets.select(F.col("cls").alias("u"), F.col("shingles").alias("s"))
    two = sets.select(F.col("cls").alias("v"), F.col("shingles").alias("t"))
    joined = pairs.join(one, "u").join(two, "v")
    both = F.size(F.array_intersect("s", "t"))
    return (joined.withColumn("both", both)
            .filter(100 * F.col("both") >= percent * (F.size("s") + F.size("t") - F.col("both")))
            .select("u", "v"))


def _rest(members: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the members that the star round left outside their bucket's largest part.

    A part is what one round of components joins; a larger component may hold several.

    All buckets with the same largest component (``main``) are one family; its outsiders meet all
    its members, in blocks of at most about ``BLOCK`` by ``BLOCK``.  A block returns a spanning
    forest of the links it confirms, never the pairs.
    """
    labelled = members.filter("m > 2").join(
        links.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    labelled = stage(labelled.select("band", "key", "cls", "n", "sk0", "sk1", "root"), "minhash-labelled")
    parts = labelled.groupBy("band", "key", "root").agg(F.count("*").alias("c"))
    main = parts.groupBy("band", "key").agg(
        F.count("*").alias("parts"), F.max_by("root", F.struct("c", "root")).alias("main"))
    family = labelled.join(main.filter("parts > 1").select("band", "key", "main"), ["band", "key"])
    family = family.select("main", "cls", "root", "n", "sk0", "sk1").distinct()
    outside = F.col("root") != F.col("main")
    sizes = family.groupBy("main").agg(F.ceil(F.count("*") / BLOCK).alias("all"),
                                       F.ceil(F.sum(outside.cast("long")) / BLOCK).alias("some"))
    family = family.join(sizes, "main").withColumn("deal", F.xxhash64("cls"))
    own_i, own_j = F.pmod("deal", "some").alias("i"), F.pmod("deal", "all").alias("j")
    every_i = F.explode(F.sequence(F.lit(0).cast("long"), F.col("some") - 1)).alias("i")
    every_j = F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1)).alias("j")
    about = ["cls", "root", "n", "sk0", "sk1"]
    blocks = family.filter(outside).select("main", own_i, every_j, F.lit(True).alias("asks"), *about).union(
        family.select("main", every_i, own_j, F.lit(False).alias("asks"), *about))
    pair = T.StructType([T.StructField("u", T.BinaryType()), T.StructField("v", T.BinaryType())])
    return blocks.join(sets, "cls").groupBy("main", "i", "j").applyInArrow(_block_links(percent), pair)


def _block_links(percent: int):
    limit = _most_differing(percent)

    def shared_counts(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
        """Intersection sizes of all sets of ``one`` with all of ``two``."""
        words = np.intersect1d(np.concatenate(one), np.concatenate(two))
        out = np.zeros((len(one), len(two)), np.float32)

        def incidence(sets: list[np.ndarray], part: np.ndarray) -> np.ndarray:
            m = np.zeros((len(sets), len(part)), np.float32)
            for i, s in enumerate(sets):
                at = np.searchsorted(part, s)
                at[at == len(part)] = 0
                m[i, at[part[at] == s]] = 1
            return m

        for lo in range(0, len(words), 8192):
            part = words[lo:lo + 8192]
            out += incidence(one, part) @ incidence(two, part).T
        return out.astype(np.int64)

    def run(block: pa.Table) -> pa.Table:
        asks = block.column("asks").to_numpy(zero_copy_only=False)
        a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
        names, n = block.column("cls").to_pylist(), block.column("n").to_numpy()
        root = np.unique(np.array([x.hex() for x in block.column("root").to_pylist()]), return_inverse=True)[1]
        differ = sum(np.bitwise_count(k[a][:, None] ^ k[b][None, :]).astype(np.int16)
                     for k in (block.column(c).to_numpy().view(np.uint64) for c in ("sk0", "sk1")))
        small, large = np.minimum.outer(n[a], n[b]), np.maximum.outer(n[a], n[b])
        open_ = (root[a][:, None] != root[b][None, :]) & (100 * small >= percent * large) & (differ <= limit)
        a, b, open_ = a[open_.any(1)], b[open_.any(0)], open_[np.ix_(open_.any(1), open_.any(0))]
        links = []
        if len(a):
            flat = block.column("shingles").combine_chunks()
            sets = {i: np.asarray(flat[i].values) for i in {*a.tolist(), *b.tolist()}}
            both = shared_counts([sets[i] for i in a.tolist()], [sets[i] for i in b.tolist()])
            found = open_ & (100 * both >= percent * (np.add.outer(n[a], n[b]) - both))
            i, j = np.nonzero(found)
            low = star(a[i], b[j], len(asks))
            links = [(names[x], names[low[x]]) for x in np.flatnonzero(low != np.arange(len(asks))).tolist()]
        return pa.table({"u": pa.array([u for u, _ in links], pa.binary()),
                         "v": pa.array([v for _, v in links], pa.binary())})
    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Where a row is found again: its id, or for want of one its text's hash; and that hash."""
    said = F.xxhash64(F.col(text_col))
    return docs.withColumns({_ROW: F.coalesce(F.col(id_col).cast("long"), said), _SAID: said})


def _resolve(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signed rows, classes, roots of the classes that are linked)."""
    keyed = _keyed(docs, id_col, text_col)
    texts = keyed.select(F.col(id_col).cast("long").alias("doc_id"), F.col(_ROW).alias("row"),
                         F.col(_SAID).alias("said"), F.col(text_col).alias("text"))
    signed = stage(arrow_map(texts, _sign(width), _SIGNED), "minhash-signed")

    classes = signed.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("sk0").alias("sk0"), F.first("sk1").alias("sk1"))
    buckets = classes.select("cls", "n", "sk0", "sk1", F.posexplode("bands").alias("band", "key"))
    mate = F.struct(F.xxhash64("band", "cls").alias("h"), "cls", "n", "sk0", "sk1")
    centres = buckets.groupBy("band", "key").agg(F.count("*").alias("m"), F.min(mate).alias("o")).filter("m > 1")
    members = stage(buckets.join(centres, ["band", "key"]).select(
        "band", "key", "m", "cls", "n", "sk0", "sk1", F.col("o.cls").alias("o_cls"), F.col("o.n").alias("o_n"),
        F.col("o.sk0").alias("o_sk0"), F.col("o.sk1").alias("o_sk1")), "minhash-members")

    stars = members.filter(F.col("cls") != F.col("o_cls")).filter(_plausible(percent))
    stars = stage(stars.select(F.least("cls", "o_cls").alias("u"), F.greatest("cls", "o_cls").alias("v")).distinct(),
                  "minhash-stars")
    asked = stars.select(F.explode(F.array("u", "v")).alias("cls")).union(
        members.filter("m > 2").select("cls")).distinct()
    sets = _read_sets(texts, asked.join(classes.select("cls", "row"), "cls"), width)
    links = hang(_confirmed(stars, sets, percent), "minhash-first")
    late = _rest(members, links, sets, percent)
    roots = components(links.union(late), "minhash-all")
    return signed, classes, roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, cls (digest of its set).

    Rows are linked when their sets of distinct ``width``-word shingles have a Jaccard
    similarity of at least ``percent`` / 100.
    """
    signed, classes, roots = _resolve(docs, id_col, text_col, width, percent)
    named = name_components(classes, roots, "doc_id")
    out = signed.select("doc_id", "n_shingles", "cls").join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "cls")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
               percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: that of the least id (rows without an id last).
    Rows with an empty set all stay."""
    signed, classes, roots = _resolve(docs, id_col, text_col, width, percent)
    linked = classes.select("cls").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
    linked = linked.withColumn("root", F.coalesce("root", "cls"))
    rows = signed.filter("cls IS NOT NULL").groupBy("cls", "doc_id", "row", "said").agg(F.count("*").alias("copies"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "said", "copies")
    best = rows.groupBy("cls").agg(F.min(rank).alias("first")).join(linked, "cls")
    best = best.groupBy("root").agg(F.min("first").alias("first")).select("first.row", "first.said", "first.copies")
    empty = signed.filter("cls IS NULL").select("row", "said", F.lit(1).cast("long").alias("copies")).distinct()
    kept = stage(best.union(empty).toDF(_ROW, _SAID, _COPIES), "minhash-kept")
    found = _keyed(docs, id_col, text_col).join(kept.hint("shuffle_hash"), [_ROW, _SAID])
    repeated = found.filter(F.col(_COPIES) > 1).dropDuplicates([_ROW, _SAID])
    return found.filter(F.col(_COPIES) == 1).union(repeated).select(*docs.columns)


def _read_sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cls, shingles) of the wanted classes, from one text of each; texts cross the network once."""
    rows = texts.join(wanted.hint("shuffle_hash"), "row").select("cls", "text")
    sets = arrow_map(rows, _sets(width), T.StructType([
        T.StructField("cls", T.BinaryType()), T.StructField("shingles", T.ArrayType(T.LongType()))]))
    return stage(sets, "minhash-sets")
