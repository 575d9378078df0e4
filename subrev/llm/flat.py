"""Words, lines and shingles of a whole Arrow column at once, as numpy arrays over its bytes.

A column of texts is one byte buffer with offsets.  Words are runs of bytes of a
class (every byte of a multi-byte character counts as a word byte), so finding
and hashing them needs no Python loop.  Hashes have 64 bits; where a result must
not rest on them alone, the operator compares the texts behind equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 4 << 20


def _table(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, n, dtype=U64)


_BYTE_AT = _table(11, 64 * 256)
_PLACE = _table(12, 64) | U64(1)

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Words between white space, and words of ASCII letters, digits and everything beyond ASCII.
NOT_SPACE = ~WHITE
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (public splitmix64 constants)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


@dataclass
class Texts:
    """``data[offsets[i]:offsets[i + 1]]`` are the bytes of text ``i``; null is empty."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array) -> Texts:
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and at[-1] else np.zeros(0, np.uint8)
    return Texts(data[at[0]: at[-1]], at - at[0])


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows of about ``size`` text bytes, a longer text alone."""
    ends = texts_of(batch.column(column)).offsets[1:]
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
        yield batch.slice(at, to - at)
        at = to


@dataclass
class Spans:
    """Runs of bytes: from, to (exclusive), the text each is in, and its hash."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of the runs of text i: first[i] to first[i + 1]


def _spans(t: Texts, inside: np.ndarray, fold: np.ndarray | None, begins: np.ndarray | None = None, hashed: bool = True) -> Spans:
    """Runs of bytes that are ``inside``; a run also begins where a text does, and at ``begins``. Without ``hashed`` there are no hashes."""
    n = len(t.data)
    cut = np.zeros(n + 1, bool)
    cut[t.offsets] = True
    if begins is not None:
        cut[begins] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:n]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    first = np.searchsorted(start, t.offsets)
    doc = np.repeat(np.arange(t.n), np.diff(first))
    if not len(start) or not hashed:
        return Spans(start, end, doc, np.zeros(0, U64), first)
    at = np.flatnonzero(inside)
    length = end - start
    place = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
    c = t.data[at] if fold is None else fold[t.data[at]]
    v = _BYTE_AT[((place & 63) << 8) | c]
    if length.max() > 64:
        # blocks of 64 bytes share the tables: each is mixed with its number before they are added up
        begin = np.flatnonzero((place & 63) == 0)
        block, number = np.add.reduceat(v, begin), place[begin] >> 6
        v = np.where(number == 0, block, mix(block ^ mix(number.astype(U64))))
        blocks = (length + 63) >> 6
        total = np.add.reduceat(v, np.cumsum(blocks) - blocks)
    else:
        total = np.add.reduceat(v, np.cumsum(length) - length)
    h = mix(total + length.astype(U64))
    return Spans(start, end, doc, h, first)


def words(t: Texts, kind: np.ndarray = NOT_SPACE, lower: bool = False) -> Spans:
    fold = LOWER if lower else None
    return _spans(t, kind[fold[t.data] if lower else t.data], fold)


def runs(t: Texts, kind: np.ndarray, begins: np.ndarray) -> Spans:
    """Runs of bytes of a class, cut in two at ``begins``, without hashes."""
    return _spans(t, kind[t.data], None, begins, hashed=False)


def lines(t: Texts) -> Spans:
    """Non-empty \\n-split lines."""
    return _spans(t, t.data != 0x0A, None)


def windows(w: Spans, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Position of the first word and hash of every run of ``size`` words inside one text."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    h = np.full(n, U64(size))
    for j in range(size):
        h += w.hash[j: j + n] * _PLACE[j % 64] * U64(2 * (j // 64) + 1)
    at = np.flatnonzero(w.doc[:n] == w.doc[size - 1:])
    return at, mix(h[at])


def in_doc(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that agree only within a text."""
    return mix(h ^ mix(doc.astype(U64) + U64(1)))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def per_doc(t: Texts, doc: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    out = np.bincount(doc, weights, minlength=t.n)
    return np.rint(out).astype(np.int64)
