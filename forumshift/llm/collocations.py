"""Phrase collocations by stripes: every prefix keys an associative counter of its next words.

Level k counts phrases of k words.  A task reads its texts in chunks and emits, for every
prefix of k-1 words, one *stripe* (the next words of that prefix and their counts); stripes of
one prefix are merged elementwise after a shuffle by prefix.  From the merged stripes come the
extensions (entries of at least ``min_count``), the counts of a phrase's left parts (handed from
the stripe of the prefix to its extensions), and the subsumption maxima (the largest entry of a
phrase's own stripe and of its reversed stripe, the phrases ending in it).

* A phrase can only be frequent if its words are.  So once the words are counted (level 1) the texts
  are staged as numbers of the frequent words of their lang, with a 0 wherever a phrase has to end, and
  levels 2 and up read those.  The ``VOCAB`` most frequent words at most are numbered once for all tasks;
  other frequent words travel as text beside the numbers (with the few that the filter lets through).
* A phrase can only be frequent if both its parts without the last and without the first word
  are, so level k counts just the places whose two phrases of k-1 words pass a Bloom filter of
  the frequent ones.  The filter is of bounded size (``bloom.FILTER_BITS``) whatever the corpus; beyond
  that it lets more through and the counts, which are exact, cost more.
* The stripes that a task sends to one place travel in one row (``_bundles``), numbers of words by
  byte planes, so the shuffle moves few rows and sorts only those.
* A prefix with ``1/HEAVY`` of all words or more (there are at most HEAVY of them a level) has its
  stripe cut into ``SLOTS`` by the next word, so no task gets the whole stripe of a hot prefix; the
  empty prefix, whose stripe holds every word, is cut by every word.
* Words are told apart by their bytes, phrases by their words: hashes only place and filter.

Cases: null and empty texts have no words; a null lang is ``und``; a text of separators has no
words; very long texts are one chunk; repeated rows count each; ties are ranked by count and then
phrase; an empty table, or one without frequent phrases, gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumshift.llm.bloom import Filter, build
from forumshift.llm.shipping import arrow_map
from forumshift.llm.staging import stage
from forumshift.llm.wordhash import byte_hashes, chunks, mix, text_buffers

HEAVY, SLOTS = 2000, 64
VOCAB = 1 << 20                 # words that have a number in every task
_CHUNK = 2 << 20
_PLACES = 1 << 20               # places, or words of level 1, whose stripes leave a task at a time
_CODES = 1 << 13                # of a staged row, about
_MERGE = 1 << 20                # entries merged at a time
_SHARE = 1 << 22                # words of the corpus for one share of a partition
_SPREAD = 512                   # partitions and their shares at least, of level 1
_BATCH_ROWS = 2500              # texts that enter one at a time
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_WORD, _BLANK, _BREAK = 0, 1, 2
_BLANKS, _BREAKS = b"\t ", b".,;:!?\n\x0b\x0c\r"
_KIND = bytes(_BLANK if i in _BLANKS else _BREAK if i in _BREAKS else _WORD for i in range(256))
_FOLD = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))

_STRIPE = T.StructType([T.StructField("lang", T.StringType()), T.StructField("prefix", T.StringType()),
                        T.StructField("next", T.ArrayType(T.StringType())), T.StructField("n", T.ArrayType(T.LongType()))])
#: Stripes of one chunk on their way to one share of a partition; ``words`` has the words without a number.
_BUNDLE = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("share", T.IntegerType()),
                        T.StructField("words", T.StringType()), T.StructField("stripes", T.BinaryType())])
_CODED = T.StructType([T.StructField("words", T.StringType()), T.StructField("codes", T.BinaryType())])
_BUNDLE_ARROW = pa.schema([("part", pa.int32()), ("share", pa.int32()), ("words", pa.string()), ("stripes", pa.binary())])
_CODED_ARROW = pa.schema([("words", pa.string()), ("codes", pa.binary())])
_STRIPE_ARROW = pa.schema([("lang", pa.string()), ("prefix", pa.string()),
                           ("next", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])


class Words:
    """The words of consecutive rows: dictionary codes, row and piece of each."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        buf = raw[offsets[0]:offsets[-1]].tobytes()
        kind = np.frombuffer(buf.translate(_KIND), np.uint8)
        cuts = (offsets[:-1] - offsets[0])
        is_word = kind == _WORD
        edge = np.ones(len(buf) + 1, bool)                 # a word starts or ends before this byte
        edge[1:-1] = is_word[1:] != is_word[:-1]
        inner = cuts[(cuts > 0) & (cuts < len(buf))]
        starts = is_word & edge[:-1]
        starts[inner] = is_word[inner]
        ends = is_word & edge[1:]
        ends[inner - 1] = is_word[inner - 1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        first = np.searchsorted(starts, cuts)
        self.row = np.repeat(np.arange(len(cuts)), np.diff(np.append(first, len(starts))))
        self.piece = np.cumsum(kind == _BREAK, dtype=np.int32)[starts] + self.row   # changes at rows and breaks
        places = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=places[1:])
        words = pa.Array.from_buffers(pa.string(), len(starts), [
            None, pa.py_buffer(places), pa.py_buffer(buf.translate(_FOLD, _BLANKS + _BREAKS))])
        coded = words.dictionary_encode()
        self.code = coded.indices.to_numpy(zero_copy_only=False)
        self.text = coded.dictionary
        self.hash = byte_hashes(*text_buffers(coded.dictionary))


def lang_hash(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs], _U)


def _named(lang: str, words: pa.Array) -> pa.Array:
    """Words of a lang as texts without blanks: the lang's bytes in hex, a point and the word, which has none."""
    return pc.binary_join_element_wise(lang.encode().hex(), words, ".")


class Vocabulary:
    """Words of langs, numbered 1, 2, ...: the hash of each word (``hash``) and of its lang (``by_lang``), with
    0 for the number 0.  ``complete`` says that no other word is frequent."""

    def __init__(self, named: pa.Array, complete: bool = False):
        self.named, self.complete = named, complete
        split = pc.split_pattern(named, ".", max_splits=1).flatten()
        langs = split.take(pa.array(np.arange(0, len(split), 2))).dictionary_encode()
        self.text = split.take(pa.array(np.arange(1, len(split), 2)))
        self.langs = [bytes.fromhex(x).decode() for x in langs.dictionary.to_pylist()]
        self.lang = langs.indices.to_numpy(zero_copy_only=False)
        self.hash, self.by_lang = np.zeros(len(named) + 1, _U), np.zeros(len(named) + 1, _U)
        if len(named):
            self.hash[1:] = byte_hashes(*text_buffers(self.text))
            self.by_lang[1:] = lang_hash(self.langs)[self.lang]

    def __len__(self) -> int:
        return len(self.named)

    def and_own(self, own: pa.Array) -> Vocabulary:
        """With words numbered on from here."""
        if not len(own):
            return self
        out, more = copy(self), Vocabulary(own)
        out.named, out.text = pa.concat_arrays([self.named, own]), pa.concat_arrays([self.text, more.text])
        out.langs = [*self.langs, *(x for x in more.langs if x not in self.langs)]
        out.lang = np.concatenate((self.lang, np.array([out.langs.index(x) for x in more.langs], np.int32)[more.lang]))
        out.hash = np.concatenate((self.hash, more.hash[1:]))
        out.by_lang = np.concatenate((self.by_lang, more.by_lang[1:]))
        return out

    def index(self) -> Vocabulary:
        """Makes words findable; of several with one hash the first."""
        key = mix(self.hash[1:] ^ self.by_lang[1:])
        order = np.argsort(key, kind="stable")
        first = np.ones(len(key), bool)
        first[1:] = key[order][1:] != key[order][:-1]
        self.complete &= bool(first.all())                 # the others travel as text
        self._place, self._sorted = order[first], key[order][first]
        return self

    def codes(self, lang: str, hashes: np.ndarray, texts: pa.Array) -> np.ndarray:
        """The number of each word of a lang, 0 if it has none."""
        if lang not in self.langs or not len(hashes):
            return np.zeros(len(hashes), np.int32)
        key = mix(hashes ^ lang_hash([lang]))
        order, at = np.argsort(key), np.empty(len(key), np.int64)
        at[order] = np.minimum(np.searchsorted(self._sorted, key[order]), len(self._sorted) - 1)
        place = self._place[at]
        same = pc.equal(self.text.take(pa.array(place)), texts).to_numpy(zero_copy_only=False)
        return np.where(same & (self.lang[place] == self.langs.index(lang)), place + 1, 0).astype(np.int32)


def phrase_hashes(word: np.ndarray, lang: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on, for all places that have k-1 places behind them."""
    n = max(0, len(word) - k + 1)
    out = word[:n].copy()
    for j in range(1, k):
        out = out * _STEP + word[j:j + n]
    return mix(out ^ lang[:n])


def _order(keys: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """(order, bits): the order of 64-bit keys without that many lower bits, far faster than argsort."""
    low = _U(max(1, len(keys) - 1).bit_length())
    order = np.sort((keys >> low << low) | np.arange(len(keys), dtype=_U))
    return (order & ((_U(1) << low) - _U(1))).astype(np.int64), low


def _groups(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, first place of each group in it): rows equal in all columns are one group.  ``keys``
    are hashes of the columns; the columns decide where two hashes are equal by chance."""
    order, low = _order(keys)
    s = keys[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    if (new[1:] & (s[1:] >> low == s[:-1] >> low)).any():  # keys that differ only in the bits left out
        order = np.argsort(keys)
        s = keys[order]
        new[1:] = s[1:] != s[:-1]
    for c in columns:
        v = c[order]
        if ((v[1:] != v[:-1]) & ~new[1:]).any():
            order = np.lexsort(columns)
            new[1:] = False
            for x in columns:
                new[1:] |= x[order][1:] != x[order][:-1]
            break
    return order, np.flatnonzero(new)


def _summed(codes: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Equal phrases (rows of ``codes``) as one, their counts (one each by default) added up."""
    if not len(codes):
        return codes, np.zeros(0, np.int64)
    if codes.shape[1] == 1:
        total = np.zeros(int(codes.max()) + 1, np.int64)
        np.add.at(total, codes[:, 0], 1 if n is None else n)
        at = np.flatnonzero(total)
        return at[:, None], total[at]
    columns = [np.ascontiguousarray(codes[:, j]) for j in range(codes.shape[1])]
    keys = columns[0].astype(_U)
    for c in columns[1:]:
        keys = keys * _STEP + c.astype(_U)
    order, first = _groups(mix(keys), columns)
    n = np.diff(np.append(first, len(order))) if n is None else np.add.reduceat(n[order], first)
    return codes[order[first]], n


def _planes(numbers: np.ndarray) -> np.ndarray:
    """The bytes of each row of 32-bit numbers."""
    return np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(len(numbers), -1)


def _numbers(planes: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` numbers of the transposed bytes."""
    return np.ascontiguousarray(planes.reshape(4 * width, -1).T).view("<i4")


def _own(codes: np.ndarray, known: int, text: pa.Array) -> tuple[np.ndarray, str]:
    """(codes, words): of the codes, which number ``text``, those beyond ``known`` number only words."""
    out = codes > known
    if not out.any():
        return codes, ""
    used, index = np.unique(codes[out], return_inverse=True)
    codes = codes.copy()
    codes[out] = index + known + 1
    return codes, " ".join(text.take(pa.array(used - 1)).to_pylist())


def _one_text(rows: list[tuple[np.ndarray, str]], known: int) -> pa.Array:
    """The words of all rows of ``_own``, whose codes are changed to number these."""
    rows = [(codes, words) for codes, words in rows if words]
    if not rows:
        return pa.array([], pa.large_string())
    split = pc.split_pattern(pa.array([words for _, words in rows], pa.large_string()), " ")
    coded = split.flatten().dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    for (codes, _), lo in zip(rows, split.offsets.to_numpy()):
        out = codes > known
        codes[out] = index[codes[out] - known - 1 + lo] + known + 1
    return coded.dictionary


def _bundles(codes: np.ndarray, n: np.ndarray, known: int, vocab: Vocabulary, heavy: np.ndarray, parts: int,
             shares: int) -> Iterator[tuple]:
    """The stripes of one chunk, those of one share of a partition in a row.  A row's stripes are
    its prefixes and sizes, its entries the next words and counts; numbers beyond ``known`` are its own."""
    k = codes.shape[1]
    prefix = vocab.by_lang[codes[:, 0]]
    if k > 1:
        acc = vocab.hash[codes[:, 0]]
        for j in range(1, k - 1):
            acc = acc * _STEP + vocab.hash[codes[:, j]]
        prefix = mix(acc ^ prefix)
        slot, heavy = np.zeros(len(codes), _U), np.sort(heavy)
        if len(heavy):
            hot = heavy[np.minimum(np.searchsorted(heavy, prefix), len(heavy) - 1)] == prefix
            slot[hot] = mix(vocab.hash[codes[hot, -1]]) % _U(SLOTS)
    else:
        slot = mix(vocab.hash[codes[:, -1]])
    where = mix(prefix + slot) % _U(parts * shares)
    bits = _U((parts * shares).bit_length())
    order, _ = _order(where << (_U(64) - bits) | prefix >> bits)
    codes, n, where = codes[order], n[order], where[order].astype(np.int64)
    new = np.ones(len(codes), bool)
    new[1:] = where[1:] != where[:-1]
    row = np.flatnonzero(new)                              # first entry of each row
    for j in range(k - 1):
        new[1:] |= codes[1:, j] != codes[:-1, j]
    if k == 1:
        new[1:] |= prefix[order][1:] != prefix[order][:-1]
    stripe = np.flatnonzero(new)
    texts = None
    if k == 1:                                             # each word once: a row's words are all its own
        edges = pa.array(np.append(row, len(codes)).astype(np.int32))
        own = vocab.named.take(pa.array(codes[:, 0] - 1)).cast(pa.string())
        texts = pc.binary_join(pa.ListArray.from_arrays(edges, own), " ").to_pylist()
        codes = (np.arange(len(codes)) - np.repeat(row, np.diff(np.append(row, len(codes)))) + 1)[:, None]
    heads = _planes(np.column_stack((codes[stripe, :-1], np.diff(np.append(stripe, len(codes))))))
    first = np.append(np.searchsorted(stripe, row), len(stripe)).tolist()
    where, row = where[row].tolist(), np.append(row, len(codes)).tolist()
    entries = _planes(np.column_stack((codes[:, -1], n))) if texts or known == len(vocab) else None
    for i, place in enumerate(where):
        (a, b), (c, d) = row[i:i + 2], first[i:i + 2]
        if entries is not None:
            head, tail, words = heads[c:d], entries[a:b], texts[i] if texts else ""
        else:
            mine, words = _own(codes[a:b], known, vocab.named)
            head = _planes(np.column_stack((mine[stripe[c:d] - a, :-1], np.diff(np.append(stripe[c:d], b)))))
            tail = _planes(np.column_stack((mine[:, -1], n[a:b])))
        yield (place // shares, place % shares, words,
               (d - c).to_bytes(4, "little") + head.T.tobytes() + tail.T.tobytes())


def _unbundled(stripes: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the phrases in a row of ``_bundles``."""
    raw = np.frombuffer(stripes, np.uint8)
    cut = 4 + 4 * k * int.from_bytes(stripes[:4], "little")
    heads, entries = _numbers(raw[4:cut], k), _numbers(raw[cut:], 2)
    return np.column_stack((np.repeat(heads[:, :-1], heads[:, -1], axis=0), entries[:, 0])), entries[:, 1].astype(np.int64)


def _sent(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of some MB at most."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1]) + len(r[-2])
        if size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, list[str]]]:
    """The words of each chunk of (lang, text), the lang of each of its rows, all langs."""
    for b in batches:
        coded = b.column(0).dictionary_encode()
        langs, lang_row = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        raw, offsets = text_buffers(b.column(1))
        for lo, hi in chunks(offsets, _CHUNK):
            yield Words(raw, offsets[lo:hi + 1]), lang_row[lo:hi], langs


def _word_stripes(batches: Iterator[pa.RecordBatch], parts: int, shares: int) -> Iterator[tuple]:
    """Level 1: stripes of the empty prefix, of some chunks together."""
    held: list[tuple[pa.Array, np.ndarray]] = []
    size = words = 0

    def out() -> Iterator[tuple]:
        coded = pa.chunked_array([x.cast(pa.large_string()) for x, _ in held]).combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)[:, None] + np.int32(1)
        yield from _bundles(*_summed(codes, np.concatenate([n for _, n in held])), 0, Vocabulary(coded.dictionary),
                            np.zeros(0, _U), parts, shares)
        held.clear()
        pa.default_memory_pool().release_unused()

    for w, lang_row, langs in _parsed(batches):
        lang = lang_row[w.row]
        for i in np.unique(lang).tolist():
            n = np.bincount(w.code[lang == i], minlength=len(w.text))
            at = np.flatnonzero(n)
            held.append((_named(langs[i], w.text.take(pa.array(at))), n[at]))
            size += len(at)
        words += len(lang)
        if size >= _PLACES // 3 or words >= 1 << 28:       # counts on their way have 31 bits
            yield from out()
            size = words = 0
    if held:
        yield from out()


def _coded(batches: Iterator[pa.RecordBatch], vocab: Vocabulary, known: Filter) -> Iterator[tuple]:
    """Rows (words, codes) of the frequent words of each chunk: their numbers in a sequence, with 0
    before each run of words that stand side by side.  Words without neighbours are left out."""
    vocab.index()
    for w, lang_row, langs in _parsed(batches):
        lang = lang_row[w.row]
        code = np.zeros(len(w.code), np.int32)
        own, size = [], 0
        for i in np.unique(lang).tolist():
            mine = lang == i
            used = np.flatnonzero(np.bincount(w.code[mine], minlength=len(w.text)))
            found = vocab.codes(langs[i], w.hash[used], w.text.take(pa.array(used)))
            if not vocab.complete:
                other = np.flatnonzero(found == 0)
                lh = np.broadcast_to(lang_hash([langs[i]]), len(other))
                other = other[known.has(phrase_hashes(w.hash[used[other]], lh, 1))]
                found[other] = np.arange(len(other)) + (len(vocab) + size + 1)
                own.append(_named(langs[i], w.text.take(pa.array(used[other]))))
                size += len(other)
            table = np.zeros(len(w.text), np.int32)
            table[used] = found
            code[mine] = table[w.code[mine]]
        names = pa.concat_arrays([vocab.named, *own]) if size else vocab.named
        at = np.flatnonzero(code)
        gap = np.ones(len(at) + 1, bool)
        gap[1:-1] = (np.diff(at) != 1) | (np.diff(w.piece[at]) != 0)
        paired = ~(gap[:-1] & gap[1:])
        at, gap = at[paired], gap[:-1][paired]
        if not len(at):
            continue
        seq = np.zeros(len(at) + int(gap.sum()), np.int32)
        seq[np.arange(len(at)) + np.cumsum(gap)] = code[at]
        starts = np.flatnonzero(seq == 0)
        cuts = np.unique(starts[np.minimum(np.searchsorted(starts, np.arange(0, len(seq), _CODES)), len(starts) - 1)]).tolist()
        for a, b in zip(cuts, cuts[1:] + [len(seq)]):
            mine, words = _own(seq[a:b], len(vocab), names)
            yield words, _planes(mine[:, None]).T.tobytes()


def _phrase_stripes(batches: Iterator[pa.RecordBatch], k: int, vocab: Vocabulary, known: Filter, heavy: np.ndarray,
                    parts: int, shares: int) -> Iterator[tuple]:
    """Level k > 1: stripes of some rows of ``_coded`` together."""
    held: list[tuple[np.ndarray, str]] = []
    size = 0

    def out() -> Iterator[tuple]:
        every = vocab.and_own(_one_text(held, len(vocab)).cast(pa.string()))
        codes = np.concatenate([c for c, _ in held])
        held.clear()
        n = max(0, len(codes) - k + 1)
        alive = codes[:n] != 0
        for j in range(1, k):
            alive &= codes[j:j + n] != 0
        prefix = phrase_hashes(every.hash[codes], every.by_lang[codes], k - 1)[:n + 1]
        near = np.zeros(len(prefix), bool)
        near[:-1] |= alive
        near[1:] |= alive
        near[near] = known.has(prefix[near])
        at = np.flatnonzero(alive & near[:-1] & near[1:])
        del prefix, alive, near
        if len(at):
            phrases = _summed(np.column_stack([codes[at + j] for j in range(k)]), None)
            del at
            yield from _bundles(*phrases, len(vocab), every, heavy, parts, shares)
            pa.default_memory_pool().release_unused()

    for b in batches:
        for words, codes in zip(b.column(0).to_pylist(), b.column(1)):
            held.append((_numbers(np.frombuffer(codes.as_buffer(), np.uint8), 1)[:, 0], words))
            size += len(held[-1][0])
            if size >= _PLACES:
                yield from out()
                size = 0
    if held:
        yield from out()


def _merge(batches: Iterator[pa.RecordBatch], k: int, min_count: int, vocab: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Merged stripes of one partition, sorted by share, with their entries of ``min_count``; the
    stripe of the empty prefix also says the sum of all its entries in a last entry without a word."""
    place = -1
    held: list[tuple[np.ndarray, np.ndarray, str]] = []
    size, most = 0, _MERGE

    def merged() -> tuple[np.ndarray, np.ndarray, pa.Array]:
        own = _one_text([(codes, words) for codes, _, words in held], len(vocab))
        return *_summed(np.concatenate([c for c, _, _ in held]), np.concatenate([n for _, n, _ in held])), own

    for b in batches:
        for share, words, found in zip(*(c.to_pylist() for c in b.columns[1:])):
            if share != place:
                if held:
                    yield from _frequent(*merged(), min_count, vocab)
                place, held, size, most = share, [], 0, _MERGE
            held.append((*_unbundled(found, k), words))
            size += len(held[-1][0])
            if size >= most:
                codes, n, own = merged()
                held = [(codes, n, " ".join(own.to_pylist()))]
                size, most = len(codes), _MERGE + 2 * len(codes)
    if held:
        yield from _frequent(*merged(), min_count, vocab)


def _frequent(codes: np.ndarray, n: np.ndarray, own: pa.Array, min_count: int, vocab: Vocabulary) -> Iterator[pa.RecordBatch]:
    """The stripes of merged phrases, with words for their numbers."""
    every, k = vocab.and_own(own.cast(pa.string())), codes.shape[1]
    kept = n >= min_count
    if k == 1:
        lang, keys = every.lang[codes[:, 0] - 1], every.text.take(pa.array(codes[kept, 0] - 1))
        for i, name in enumerate(every.langs):
            mine = lang == i
            if mine.any():
                words = pa.concat_arrays([keys.filter(pa.array(mine[kept])), pa.nulls(1, pa.string())])
                counts, edges = np.append(n[kept & mine], n[mine].sum()), pa.array([0, len(words)], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([""]), pa.ListArray.from_arrays(edges, words),
                                                  pa.ListArray.from_arrays(edges, pa.array(counts))], schema=_STRIPE_ARROW)
    elif kept.any():
        codes, n = codes[kept], n[kept]
        order = np.lexsort(codes.T[::-1])
        codes, n = codes[order], n[order]
        new = np.ones(len(n), bool)
        new[1:] = (codes[1:, :-1] != codes[:-1, :-1]).any(axis=1)
        first = np.flatnonzero(new)
        edges = pa.array(np.append(first, len(n)).astype(np.int32))
        heads = [every.text.take(pa.array(codes[first, j] - 1)) for j in range(k - 1)]
        yield pa.RecordBatch.from_arrays([
            pa.array(every.langs, pa.string()).take(pa.array(every.lang[codes[first, 0] - 1])),
            pc.binary_join_element_wise(*heads, " ") if k > 2 else heads[0],
            pa.ListArray.from_arrays(edges, every.text.take(pa.array(codes[:, -1] - 1))),
            pa.ListArray.from_arrays(edges, pa.array(n))], schema=_STRIPE_ARROW)


def stripes(texts: DataFrame, k: int, min_count: int, vocab=None, known: tuple | None = None,
            heavy: np.ndarray | None = None, words: int = 0) -> DataFrame:
    """Merged stripes (lang, prefix, next, n) of all phrases of k words: of (lang, text) for k = 1, else of
    ``coded`` texts and the broadcast vocabulary.  ``words`` of the corpus, which bound a share."""
    spark = texts.sparkSession
    # whole texts are long: fewer rows a batch, on either side of the Arrow exchange
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_BATCH_ROWS))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = max(1, -(-words // (parts * _SHARE)) if words else -(-_SPREAD // parts))
    shared = spark.sparkContext.broadcast((known, heavy))

    def numbered() -> Vocabulary:
        return vocab.value if vocab else Vocabulary(pa.array([], pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if k == 1:
            return _sent(_word_stripes(batches, parts, shares), _BUNDLE_ARROW)
        bits, hot = shared.value
        return _sent(_phrase_stripes(batches, k, numbered(), Filter(*bits), hot, parts, shares), _BUNDLE_ARROW)

    dealt = arrow_map(texts, run, _BUNDLE).repartitionById(parts, "part").sortWithinPartitions("share")
    return stage(arrow_map(dealt, lambda batches: _merge(batches, k, min_count, numbered()), _STRIPE), f"stripes-{k}")


def coded(texts: DataFrame, vocab, known: tuple) -> DataFrame:
    """The frequent words of (lang, text) as numbers of the broadcast vocabulary (``_coded``), staged;
    ``known`` is the filter of the frequent words."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sent(_coded(batches, vocab.value, Filter(*shared.value)), _CODED_ARROW)
    return stage(arrow_map(texts, run, _CODED), "coded", "zstd")


def _vocabulary(level: DataFrame, n: int) -> Vocabulary:
    """The VOCAB most frequent of n frequent words, or somewhat fewer, most frequent first."""
    if n > VOCAB:
        least = level.agg(F.expr(f"approx_percentile(a, {1 - VOCAB / n:.12f}BD, 10000)")).first()[0]
        level = level.filter(F.col("a") > least)
    found = level.select(F.concat_ws(".", F.lower(F.hex(F.encode("lang", "UTF-8"))), "phrase").alias("named"), "a").toArrow()
    order = np.argsort(-found.column("a").to_numpy(), kind="stable")
    return Vocabulary(found.column("named").cast(pa.string()).combine_chunks().take(pa.array(order)), n <= VOCAB)


def _filter_of(phrases: DataFrame, k: int, n: int) -> tuple:
    """The Bloom filter of n phrases of k words."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(b.column(0), b.column(1), k).view(np.int64))], ["h"])
    return build(arrow_map(phrases.select("lang", "phrase"), hashes, "h long"), n)


def _hashes(langs: pa.Array, phrases: pa.Array, k: int) -> np.ndarray:
    w = Words(*text_buffers(phrases))
    coded = langs.dictionary_encode()
    lang = lang_hash(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
    if not len(phrases):
        return np.zeros(0, _U)
    return phrase_hashes(w.hash[w.code], lang[w.row], k)[::k]


def _heavy_of(phrases: DataFrame, k: int, words: int) -> np.ndarray:
    """Hashes of the phrases that stand at 1/HEAVY of all places or more (HEAVY at most)."""
    rows = phrases.filter(F.col("a") >= max(1, -(-words // HEAVY))).select("lang", "phrase").collect()
    return _hashes(pa.array([r.lang for r in rows], pa.string()), pa.array([r.phrase for r in rows], pa.string()), k)


def collocations(docs: DataFrame, min_count: int = 100, longest: int = 5, percent: int = 100, top: int = 2000,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of 2 to ``longest`` words of each
    lang with ``min_count`` occurrences, by score, that no longer one with ``percent`` of their
    occurrences contains."""
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    texts = texts.filter("text IS NOT NULL")
    merged = stripes(texts, 1, min_count)
    entries = merged.select("lang", F.inline(F.arrays_zip("next", "n")))
    sizes = entries.filter("next IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    level = stage(entries.filter("next IS NOT NULL").select(
        "lang", F.col("next").alias("phrase"), F.col("n").alias("a"), F.array("n").alias("lefts"),
        F.array().cast("array<long>").alias("rights")), "phrases-1")
    words = sizes.agg(F.sum("n")).first()[0] or 0
    found: list[DataFrame] = []
    for k in range(2, longest + 1):
        n = level.count()
        if n:
            known = _filter_of(level, k - 1, n)
            if k == 2:
                vocab = docs.sparkSession.sparkContext.broadcast(_vocabulary(level, n))
                texts = coded(texts, vocab, known)
            merged = stripes(texts, k, min_count, vocab, known, _heavy_of(level, k - 1, words), words)
        else:
            merged = merged.limit(0)
        level = _extended(level, merged)
        found.append(level)
    every = found[0].withColumn("k", F.lit(2))
    for k, f in enumerate(found[1:], 3):
        every = every.union(f.withColumn("k", F.lit(k)))
    return _ranked(every, sizes, percent, top)


def _extended(level: DataFrame, merged: DataFrame) -> DataFrame:
    """The frequent phrases of the merged stripes.  Counts of the left parts come with the stripe's
    prefix, those of the right parts with the stripe of the phrases that share the rest."""
    parts = level.select("lang", F.col("phrase").alias("prefix"), F.col("lefts").alias("before"))
    grown = merged.join(parts, ["lang", "prefix"])
    grown = grown.select("lang", "prefix", "before", F.inline(F.arrays_zip("next", "n")))
    grown = grown.select(
        "lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.col("n").alias("a"),
        F.concat("before", F.array("n")).alias("lefts"))
    # all phrases with one rest, in stripes, so that a common rest is joined once for many of them
    rest = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    ending = grown.groupBy("lang", rest.alias("rest"), F.pmod(F.xxhash64("phrase"), F.lit(SLOTS)).alias("slot")).agg(
        F.collect_list(F.struct("phrase", "a", "lefts")).alias("all"))
    after = level.select("lang", F.col("phrase").alias("rest"), F.concat(F.array("a"), "rights").alias("rights"))
    ending = ending.join(after, ["lang", "rest"]).select("lang", "rights", F.inline("all"))
    return stage(ending.select("lang", "phrase", "a", "lefts", "rights"), "phrases")


def _ranked(phrases: DataFrame, sizes: DataFrame, percent: int, top: int) -> DataFrame:
    longer = phrases.filter("k > 2")
    drop_last = F.expr("substring_index(phrase, ' ', k - 1)")
    drop_first = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    around = longer.select("lang", drop_last.alias("phrase"), "a").union(longer.select("lang", drop_first, "a"))
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = phrases.join(around, ["lang", "phrase"], "left").filter(
        F.coalesce(F.lit(100) * F.col("most") < F.lit(percent) * F.col("a"), F.lit(True)))
    cuts = F.expr("""transform(sequence(1, k - 1), j -> named_struct(
        'score', (cast(1000 as decimal(38, 0)) * a * n) div (cast(lefts[j - 1] as decimal(38, 0)) * rights[j - 1]),
        'j', j, 'l', lefts[j - 1], 'r', rights[j - 1]))""")
    scored = kept.join(F.broadcast(sizes), "lang").withColumn("cut", F.array_min(cuts)).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
