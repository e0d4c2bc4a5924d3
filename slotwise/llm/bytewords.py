"""Words and n-grams of text batches as numpy arrays.

Texts are handled as UTF-8 bytes. A batch is cut into chunks of bounded size
(one long text may exceed the bound, never a group of texts), the chunk's
texts are joined by a newline, and words, lines and n-grams get 64-bit hashes
from one pass of prefix sums. Hashes depend on the content only, so they agree
between tasks, runs and machines.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D           # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_ORDER = mix(np.arange(1001, 1065, dtype=np.uint64) * _STEP) | np.uint64(1)   # odd, one per n-gram place
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse; kept up to 4 M entries."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    size = max(n, 1 << 20)
    out = []
    for b in (_BASE, _BASE_INV):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if size <= 1 << 22:
        _POWERS[:] = out
    return out[0][:n], out[1][:n]


def byte_table(*excluded: tuple[int, int]) -> np.ndarray:
    """Boolean table of the bytes outside the given inclusive ranges."""
    t = np.ones(256, bool)
    for lo, hi in excluded:
        t[lo:hi + 1] = False
    return t


# Words [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (fixed values).
SPACED = byte_table((0x20, 0x20), (0x09, 0x0D))
ALNUM = byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Chunk:
    """Some texts joined by newlines, with their words."""

    raw: np.ndarray         # bytes, each text followed by a newline
    doc_start: np.ndarray   # first byte per text, plus one past the last newline
    start: np.ndarray       # per word
    end: np.ndarray
    word: np.ndarray        # hash per word
    first: np.ndarray       # first word per text, plus the number of words
    prefix: np.ndarray      # prefix sums behind range_hash

    @property
    def n(self) -> int:
        return len(self.doc_start) - 1

    @property
    def doc(self) -> np.ndarray:
        """Text index per word."""
        return np.repeat(np.arange(self.n), np.diff(self.first))

    def range_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Content hash of byte ranges."""
        inv = powers(len(self.raw) + 1)[1]
        return mix((self.prefix[end] - self.prefix[start]) * inv[start])

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of every run of ``n`` words inside one text."""
        if len(self.word) < n:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        doc = self.doc
        at = np.flatnonzero(doc[:len(doc) - n + 1] == doc[n - 1:])
        return gram_hash(self.word, at, n), at


def gram_hash(word: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place of ``at`` on."""
    h = np.zeros(len(at), np.uint64)
    for j in range(n):
        h += word[at + j] * _ORDER[j]
    return mix(h)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def trim() -> None:
    if _TRIM is not None:
        _TRIM(0)


def tidy(run):
    """``run``, a function over a task's Arrow batches, that gives freed memory
    back to the system after each batch. Workers live on between tasks and
    operators, and the C allocator would keep what the largest batch took."""
    @functools.wraps(run)
    def whole(batches):
        def each():
            for b in batches:
                yield b
                trim()
        yield from run(each())
    return whole


def blobs(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes; null becomes empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def chunk_ranges(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of texts of about ``limit`` bytes together."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def parse(texts: list[bytes], table: np.ndarray, lower: bool) -> Chunk:
    """The words of one chunk; ``lower`` folds A-Z before anything else."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        raw = LOWER[raw]
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    doc_start = np.concatenate(([0], np.cumsum(sizes)))
    inside = table[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]       # the last byte is a newline: edges pair up
    power, _ = powers(len(raw) + 1)
    prefix = np.empty(len(raw) + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(_BYTE[raw] * power[:-1], out=prefix[1:])
    c = Chunk(raw, doc_start, start, end, np.empty(0, np.uint64), np.searchsorted(start, doc_start), prefix)
    c.word = c.range_hash(start, end)
    return c


def chunks(column: pa.Array, table: np.ndarray, lower: bool, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Chunk]]:
    """(first row, end row, chunk) over a string column."""
    texts = blobs(column)
    for lo, hi in chunk_ranges(texts, limit):
        yield lo, hi, parse(texts[lo:hi], table, lower)


def per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive positions of ``first``."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Per entry: whether its key occurs more than once."""
    order = np.argsort(keys)
    k = keys[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    out = np.empty(len(k), bool)
    out[order] = same[1:] | same[:-1]
    return out


def later_copy(keys: np.ndarray) -> np.ndarray:
    """Per entry: whether its key occurs at an earlier entry."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    out = np.zeros(len(k), bool)
    out[order[1:]] = k[1:] == k[:-1]
    return out


def covered(at: np.ndarray, length: int, size: int) -> np.ndarray:
    """Places inside any of the runs of ``length`` that start at ``at``."""
    d = np.zeros(size + 1, np.int32)
    np.add.at(d, at, 1)
    np.add.at(d, at + length, -1)
    return np.cumsum(d[:-1]) > 0


def salted(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Keys that differ between texts."""
    return mix(keys + (doc.astype(np.uint64) + np.uint64(1)) * _STEP)


_FILTER_BITS = 22


def lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in ``keys``, index in the sorted ``table``) of the keys that
    the table holds; a bit map of the low bits spares most searches."""
    if not len(table) or not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    mask = np.uint64((1 << _FILTER_BITS) - 1)
    seen = np.zeros(1 << _FILTER_BITS, bool)
    seen[table & mask] = True
    at = np.flatnonzero(seen[keys & mask])
    k = keys[at]
    i = np.minimum(np.searchsorted(table, k), len(table) - 1)
    ok = table[i] == k
    return at[ok], i[ok]
