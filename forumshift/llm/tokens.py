"""Token ids of whole texts with the ``tokenizers`` library, one distinct word at a time.

The pre-tokenizers of both public vocabularies never join characters across a space that
follows a non-space, so a text's ids are those of its space-separated chunks in order.  A batch
is cut into chunks, hashed and made distinct with numpy; the library encodes every chunk that
the worker has not met yet, and the ids are gathered from a table of bounded size.  Texts with
two spaces in a row, where chunks would be ambiguous, are encoded whole.

How a vocabulary treats spaces: "kept" when a space belongs to the word after it (byte-level),
"dropped" when white space only separates words, "whole" for any other: no chunks at all.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from forumshift.llm.wordhash import chunks, mix, powers, text_buffers

TABLE_WORDS = 1_200_000    # known chunks per worker, about 40 MB; the table starts anew beyond
BATCH_BYTES = 1 << 20      # text per round; a longer text is a round of its own
_PIECE = 500               # chunks given to the library at a time
_VALUE = np.random.default_rng(20240301).integers(1, 1 << 63, 256, dtype=np.uint64)


def vocabulary(path: str) -> str:
    """The tokenizer file's text (a bounded vocabulary), to be broadcast by the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def spaces_of(spec: str) -> str:
    """How the tokenizer treats spaces, read from its own description."""
    d = json.loads(spec)
    pre, norm = d.get("pre_tokenizer") or {}, d.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
        return "kept"
    split = (pre.get("pretokenizers") or [{}])[0]
    if (split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert")
            and "\\s" in split["pattern"].get("Regex", "")
            and [n.get("type") for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]):
        return "dropped"
    return "whole"


class Encoder:
    """Packed little-endian ids of texts; ``dtype`` is the narrowest that holds the vocabulary."""

    def __init__(self, spec: str, end_id: int, spaces: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # one task, one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True      # their strings in a text are ordinary text
        top = max([end_id, *self.tokenizer.get_vocab(with_added_tokens=True).values()])
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.spaces = spaces or spaces_of(spec)
        self._forget()

    def _forget(self) -> None:
        self.hash = np.zeros(0, np.uint64)               # ascending
        self.at = np.zeros(0, np.int64)                  # first id in ``ids``
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, self.dtype)
        self.used = 0

    def _library(self, texts: list[str]) -> Iterator[list[int]]:
        for i in range(0, len(texts), _PIECE):
            for e in self.tokenizer.encode_batch_fast(texts[i:i + _PIECE], add_special_tokens=False):
                yield e.ids

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        if len(self.hash) + len(hashes) > TABLE_WORDS:
            self._forget()
        size, flat = np.empty(len(texts), np.int64), []
        for i, ids in enumerate(self._library(texts)):
            size[i] = len(ids)
            flat += ids
        need = self.used + len(flat)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(2 * need - self.used, self.dtype)])
        self.ids[self.used:need] = flat
        at = self.used + np.cumsum(size) - size
        self.used = need
        every = np.concatenate([self.hash, hashes])
        order = np.argsort(every, kind="stable")
        self.hash = every[order]
        self.at = np.concatenate([self.at, at])[order]
        self.size = np.concatenate([self.size, size])[order]

    def _cut(self, buf: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all chunks, and which rows cannot be cut."""
        whole = np.zeros(len(rows) - 1, bool)
        if self.spaces == "kept":
            space = buf == 32
            first = np.zeros(len(buf), bool)
            first[rows[:-1][rows[:-1] < rows[1:]]] = True
            twice = np.flatnonzero(space[1:] & space[:-1] & ~first[1:])
            whole[np.searchsorted(rows, twice, side="right") - 1] = True
            starts = np.flatnonzero(space | first)
            ends = np.append(starts[1:], len(buf))
        else:
            word = (buf != 32) & (buf != 10)
            first = np.zeros(len(buf) + 1, bool)
            first[rows] = True
            starts = np.flatnonzero(word & (first[:-1] | np.concatenate(([True], ~word[:-1]))))
            ends = np.flatnonzero(word & (first[1:] | np.concatenate((~word[1:], [True])))) + 1
        return starts, ends, whole

    def _round(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        buf, rows = raw[offsets[0]:offsets[-1]], offsets - offsets[0]
        if not len(buf):
            yield from [self.end] * (len(rows) - 1)
            return

        def text(a: int, b: int) -> str:
            return buf[a:b].tobytes().decode("utf-8", "surrogatepass")

        starts, ends, whole = self._cut(buf, rows)
        up, down = powers(len(buf) + 1)
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_VALUE[buf] * up[:len(buf)], out=total[1:])
        h = mix((total[ends] - total[starts]) * down[starts])
        order = np.argsort(h)
        ranked = h[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1]))[:len(h)]
        distinct, sample = ranked[new], order[new]
        if len(distinct) > TABLE_WORDS // 2:                          # never in a round of bounded size
            whole[:] = True
        else:
            where = np.searchsorted(self.hash, distinct)
            known = np.zeros(len(distinct), bool)
            inside = where < len(self.hash)
            known[inside] = self.hash[where[inside]] == distinct[inside]
            if not known.all():
                if len(self.hash) + (~known).sum() > TABLE_WORDS:
                    self._forget()
                    known[:] = False
                miss = sample[~known]
                self._learn(distinct[~known], [text(a, b) for a, b in zip(starts[miss].tolist(), ends[miss].tolist())])
                where = np.searchsorted(self.hash, distinct)
            entry = np.empty(len(h), np.int64)
            entry[order] = where[np.cumsum(new) - 1]
            size = self.size[entry]
            stop = np.concatenate(([0], np.cumsum(size)))
            ids = self.ids[np.repeat(self.at[entry] - stop[:-1], size) + np.arange(stop[-1])]
            cut = stop[np.searchsorted(starts, rows)].tolist()
        for i, alone in enumerate(whole.tolist()):
            if alone:
                one = next(self._library([text(rows[i], rows[i + 1])]))
                yield np.array(one, self.dtype).tobytes() + self.end
            else:
                yield ids[cut[i]:cut[i + 1]].tobytes() + self.end

    def encode(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of every text of a string column (null: empty), each followed by the end id."""
        if self.spaces == "whole":
            for x in column:
                yield np.array(next(self._library([x.as_py() or ""])), self.dtype).tobytes() + self.end
            return
        raw, offsets = text_buffers(column)
        for lo, hi in chunks(offsets, BATCH_BYTES):
            yield from self._round(raw, offsets[lo:hi + 1])


_MADE: dict = {}


def encoder(spec: str, end_id: int) -> Encoder:
    """The worker's encoder of this vocabulary; its table lives as long as the worker."""
    key = (hash(spec), len(spec), end_id)
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Encoder(spec, end_id)
    return _MADE[key]
