"""Token ids in raw binary shards, with a minimal perfect hash index per shard.

A shard is a payload file (nothing but little-endian ids of its documents, ascending by id) and
an index file: a minimal perfect hash over the document keys whose slots hold a fingerprint of
the key and the offset and length of its ids, so a key is found in constant time and a foreign
key is refused.  Documents are range-partitioned by id, so shards follow one another in id
order; only one row per shard (the manifest) describes the store.

File names are unique per task attempt and only those in the manifest count, so a task that is
repeated after a lost executor leaves nothing wrong.  Files are written with Arrow's file
systems to the folder given (local, HDFS or object store).

Cases: null and empty texts are the end id alone; null ids come first, repeated ids are told
apart by their occurrence in the shard (ordered by text hash); an empty table makes an empty
manifest; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumshift.llm.shipping import arrow_map
from forumshift.llm.staging import new_folder, stage
from forumshift.llm.tokens import encoder, vocabulary
from forumshift.llm.wordhash import mix

_MAGIC = b"IDSHARD1"
_U = np.uint64
_SEEDS = np.random.default_rng(31).integers(1, 1 << 63, 64, dtype=np.uint64)
GAMMA = 2.0


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def key_hash(ids: np.ndarray, nulls: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    x = mix(ids.astype(np.int64).view(np.uint64) + nulls.astype(np.uint64) * _U(0x5851F42D4C957F2D))
    return mix(x * _U(0x9E3779B97F4A7C15) + occurrence.astype(np.uint64))


def _fingerprint(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ _U(0xD6E8FEB86659FD93)) >> _U(32)).astype(np.uint32)


class MinimalPerfectHash:
    """Bit tables, one per level: a key owns the first bit that no other key of its level wants;
    the rank of that bit is its slot, so slots are 0..n-1 without gaps."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels                              # packed bits
        self.sizes = [len(x) * 8 for x in levels]
        ones = np.concatenate([np.bitwise_count(x) for x in levels]) if levels else np.zeros(0, np.uint8)
        self.before = np.concatenate(([0], np.cumsum(ones, dtype=np.int64)))   # ones before each byte
        self.first = np.cumsum([0] + [len(x) for x in levels])

    @staticmethod
    def _position(h: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(h ^ _SEEDS[level]) % _U(size)).astype(np.int64)

    @classmethod
    def build(cls, h: np.ndarray) -> MinimalPerfectHash:
        levels, left = [], h
        while len(left):
            if len(levels) == len(_SEEDS):
                raise ValueError("keys with equal hashes")
            size = max(64, -(-int(GAMMA * len(left)) // 64) * 64)
            at = cls._position(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slot of every key hash; -1 where no level has a bit for it (a foreign key)."""
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for k, (bits, size) in enumerate(zip(self.levels, self.sizes)):
            at = self._position(h[left], k, size)
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            hit = (bits[byte] >> bit) & 1 == 1
            below = np.bitwise_count(bits[byte] & ((np.uint8(1) << bit) - np.uint8(1)).astype(np.uint8))
            out[left[hit]] = (self.before[self.first[k] + byte] + below)[hit]
            left = left[~hit]
        return out


def write_index(keys: np.ndarray, nulls: np.ndarray, occurrence: np.ndarray, lengths: np.ndarray, width: int) -> bytes:
    h = key_hash(keys, nulls, occurrence)
    mph = MinimalPerfectHash.build(h)
    slot = mph.slots(h)
    marks, offset, length = np.empty(len(h), "<u4"), np.empty(len(h), "<u8"), np.empty(len(h), "<u8")
    marks[slot] = _fingerprint(h)
    offset[slot] = np.cumsum(lengths) - lengths
    length[slot] = lengths
    parts = [*mph.levels, marks, offset, length, keys.astype("<i8"), np.packbits(nulls, bitorder="little"),
             occurrence.astype("<u4")]
    head = json.dumps({"n": len(h), "width": width, "levels": [len(x) for x in mph.levels]}).encode()
    return b"".join([_MAGIC, len(head).to_bytes(4, "little"), head, *(x.tobytes() for x in parts)])


class Shard:
    """One shard opened for keyed reading."""

    def __init__(self, payload: str, index: str):
        fs, path = _filesystem(index)
        with fs.open_input_file(path) as f:
            raw = f.read()
        if raw[:8] != _MAGIC:
            raise ValueError(f"not a shard index: {index}")
        at = 12 + int.from_bytes(raw[8:12], "little")
        head = json.loads(raw[12:at])
        n = head["n"]

        def take(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(raw, dtype, count, at)
            at += x.nbytes
            return x

        self.mph = MinimalPerfectHash([take("u1", k) for k in head["levels"]])
        self.marks, self.offset, self.length = take("<u4", n), take("<u8", n), take("<u8", n)
        self.keys = take("<i8", n)
        self.nulls = np.unpackbits(take("u1", -(-n // 8)), count=n, bitorder="little").astype(bool)
        self.occurrence = take("<u4", n)
        self.dtype = np.dtype(f"<u{head['width']}")
        fs, path = _filesystem(payload)
        self.payload = fs.open_input_file(path)

    def locate(self, ids: np.ndarray, nulls: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
        """Slot of every key, -1 for keys that the shard does not hold."""
        h = key_hash(ids, nulls, occurrence)
        slot = self.mph.slots(h)
        if len(self.marks):
            slot[(slot >= 0) & (self.marks[slot] != _fingerprint(h))] = -1
        return slot

    def read(self, slot: int) -> np.ndarray:
        w = self.dtype.itemsize
        self.payload.seek(int(self.offset[slot]) * w)
        return np.frombuffer(self.payload.read(int(self.length[slot]) * w), self.dtype)

    def get(self, doc_id: int | None, occurrence: int = 0) -> np.ndarray | None:
        """The ids of one document, or None."""
        slot = self.locate(np.array([doc_id or 0], np.int64), np.array([doc_id is None]), np.array([occurrence]))[0]
        return None if slot < 0 else self.read(slot)


_MANIFEST = [("shard", T.LongType()), ("payload", T.StringType()), ("index", T.StringType()),
             ("n_docs", T.LongType()), ("n_null", T.LongType()), ("n_tokens", T.LongType()), ("first_id", T.LongType()),
             ("last_id", T.LongType())]


def write_store(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Write the shards and return the manifest, with ``base``: the ids in all shards before."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-store")
    spec = spark.sparkContext.broadcast(vocabulary(tokenizer))
    schema = pa.schema([(n, pa.string() if isinstance(t, T.StringType) else pa.int64()) for n, t in _MANIFEST])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(spec.value, end_id)
        fs, path = _filesystem(folder)
        shard, ids, nulls, lengths = TaskContext.get().partitionId(), [], [], []
        stem, out = f"shard-{shard:06d}-{uuid.uuid4().hex}", None
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(f"{path}/{stem}.ids")
            ids.append(b.column(0).fill_null(0).to_numpy())
            nulls.append(b.column(0).is_null().to_numpy(zero_copy_only=False))
            for raw in enc.encode(b.column(1)):
                lengths.append(len(raw) // enc.dtype.itemsize)
                out.write(raw)
        if out is None:
            return
        out.close()
        keys, none, n = np.concatenate(ids), np.concatenate(nulls), np.array(lengths, np.int64)
        fresh = np.concatenate(([True], (keys[1:] != keys[:-1]) | (none[1:] != none[:-1])))
        at = np.arange(len(keys))
        occurrence = at - np.maximum.accumulate(np.where(fresh, at, 0))
        with fs.open_output_stream(f"{path}/{stem}.mph") as f:
            f.write(write_index(keys, none, occurrence, n, enc.dtype.itemsize))
        real = keys[~none]
        row = (shard, f"{folder}/{stem}.ids", f"{folder}/{stem}.mph", len(keys), int(none.sum()), int(n.sum()),
               int(real[0]) if len(real) else None, int(real[-1]) if len(real) else None)
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = texts.withColumn("tie", F.xxhash64("text"))
    dealt = order.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    manifest = stage(arrow_map(dealt, run, T.StructType([T.StructField(n, t) for n, t in _MANIFEST])), "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)      # one row per shard
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_store(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, each found through the index."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for payload, index, base in zip(*(c.to_pylist() for c in b.columns)):
                shard = Shard(payload, index)
                slots = shard.locate(shard.keys, shard.nulls, shard.occurrence)
                if len(slots) and slots.min() < 0:
                    raise ValueError(f"a key of {index} is not found through it")
                for lo in range(0, len(slots), 4096):
                    part = slots[lo:lo + 4096]
                    crc = [zlib.crc32(shard.read(s).astype("<u4").tobytes()) for s in part]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard.keys[lo:lo + 4096], mask=shard.nulls[lo:lo + 4096]),
                        pa.array((shard.offset[part] + np.uint64(base)).astype(np.int64)),
                        pa.array(shard.length[part].astype(np.int64)), pa.array(crc, pa.int64())], schema=schema)

    # a task per shard, whatever the bytes of its manifest row
    last = manifest.agg(F.max("shard")).first()[0]
    rows = manifest.select("payload", "index", "base", F.col("shard").cast("int").alias("shard"))
    rows = rows.repartitionById((last or 0) + 1, "shard").drop("shard")
    return arrow_map(rows, run, T.StructType([T.StructField(f.name, T.LongType()) for f in schema]))


class Store:
    """Keyed reading over all shards of a manifest.  Which shards may hold an id is asked of the
    manifest; each answers from its index."""

    def __init__(self, manifest: DataFrame):
        self.manifest, self._open = manifest, {}

    def get(self, doc_id: int | None, occurrence: int = 0) -> np.ndarray | None:
        """The ids of a document, or None.  Documents of one id are numbered in their order, over the
        shards."""
        held = F.col("n_null") > 0 if doc_id is None else F.lit(doc_id).between(F.col("first_id"), F.col("last_id"))
        for row in self.manifest.filter(held).orderBy("shard").select("payload", "index").toLocalIterator():
            if row not in self._open:
                if len(self._open) >= 8:
                    self._open.pop(next(iter(self._open)))
                self._open[row] = Shard(*row)
            k = 0
            while (found := self._open[row].get(doc_id, k)) is not None:
                if occurrence == 0:
                    return found
                occurrence, k = occurrence - 1, k + 1
        return None
