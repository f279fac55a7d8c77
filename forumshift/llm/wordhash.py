"""Vectorised word and shingle hashing over Arrow text batches (used inside tasks).

Words are maximal runs of bytes outside space and 0x09-0x0D; A-Z count as a-z.  A word's hash
is a polynomial in random per-byte values modulo 2**64, read off one running sum over the
whole batch, so no Python object is made per word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
CHUNK_BYTES = 1 << 20          # text hashed at a time; a longer document is one chunk

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]   # ASCII case folds; nothing else does
_WORD = np.ones(256, dtype=bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_BASE = int(_rng.integers(1, 1 << 63)) | 1
_STEP = _U(int(_rng.integers(1, 1 << 63)) | 1)
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _POWERS.clear()
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls have no bytes."""
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; every row is in exactly one, whole."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words_at(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, hash) of every word of consecutive rows, in order; positions count from
    the first row's first byte."""
    base = offsets[0]
    buf = raw[base:offsets[-1]]
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    is_word = _WORD[buf]
    cuts = offsets[:-1] - base
    cuts = cuts[cuts < len(buf)]
    before = np.empty(len(buf), dtype=bool)
    before[0] = False
    before[1:] = is_word[:-1]
    before[cuts] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.empty(len(buf), dtype=bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    up, down = powers(len(buf) + 1)
    total = np.empty(len(buf) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts])
    return np.searchsorted(offsets - base, starts, side="right") - 1, starts, ends, hashes


def byte_hashes(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hash of each string of a column; a word's is the same as in ``words``."""
    base = offsets[0]
    buf = raw[base:offsets[-1]]
    up, down = powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=total[1:])
    at = offsets - base
    return mix((total[at[1:]] - total[at[:-1]]) * down[at[:-1]])


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word of consecutive rows, in order."""
    row, _, _, hashes = words_at(raw, offsets)
    return row, hashes


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Per chunk: (first row, sorted distinct shingle hashes of each row).

    Rows with fewer than ``width`` words have their whole word sequence as the one shingle;
    rows without words (null or blank text) have an empty set.
    """
    raw, offsets = text_buffers(column)
    for lo, hi in chunks(offsets):
        row, h = words(raw, offsets[lo:hi + 1])
        first = np.searchsorted(row, np.arange(hi - lo + 1))
        acc = h.copy()
        for k in range(1, width):
            acc = acc[:len(h) - k] * _STEP + h[k:] if len(h) > k else acc[:0]
        acc = mix(acc)
        sets = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= width:
                s = np.sort(acc[a:b - width + 1])
                sets.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
            elif b > a:
                one = h[a:a + 1]
                for k in range(a + 1, b):
                    one = one * _STEP + h[k:k + 1]
                sets.append(mix(one ^ _U(b - a)))
            else:
                sets.append(h[:0])
        yield lo, sets


def digest(sorted_set: np.ndarray) -> bytes:
    return hashlib.blake2b(sorted_set.tobytes(), digest_size=16).digest()
