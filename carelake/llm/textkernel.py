"""Numpy kernels over blocks of UTF-8 texts, used inside Arrow tasks.

Texts are handled as one byte array with document offsets.  Words are maximal runs
of the bytes that ``word_table`` marks; word classes here differ from white space or
punctuation in ASCII only, so the bytes of other letters always belong to words.
Word and shingle identity is a 64-bit hash: a polynomial over random byte values,
taken for all words at once from prefix sums (arithmetic modulo 2**64).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; bounds the temporaries, not the length of a document.
BLOCK = 1 << 21
_rng = np.random.default_rng(20240131)
BYTE_VALUE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
MIX = [np.uint64(int(x) | 1) for x in _rng.integers(1, 2**64 - 1, 8, dtype=np.uint64)]
_powers: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_table(*gaps: tuple[int, int]) -> np.ndarray:
    """True for the bytes outside the inclusive ranges ``gaps``."""
    t = np.ones(256, bool)
    for a, b in gaps:
        t[a:b + 1] = False
    return t


LOWER = lower_table()
#: Words for sizes and shingles: anything but ASCII white space.
SPACED = word_table((0x20, 0x20), (0x09, 0x0D))
#: Words for benchmark passages: ASCII letters and digits and all non-ASCII bytes.
ALNUM = word_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary or string column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    large = pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type)
    if col.null_count:
        col = col.fill_null(b"" if "binary" in str(col.type) else "")
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if large else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64) \
        if len(col) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.empty(0, np.uint8)
    return buf, off - off[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer document."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        for k, b in enumerate((BASE, INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of ``h`` over all bits of the result."""
    h = (h ^ (h >> np.uint64(32))) * MIX[0]
    h = (h ^ (h >> np.uint64(29))) * MIX[1]
    return h ^ (h >> np.uint64(32))


def words(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): the 64-bit hash of every word, A-Z lower-cased, and words per document."""
    n = len(buf)
    counts = np.zeros(len(offsets) - 1, np.int64)
    if not n:
        return np.empty(0, np.uint64), counts
    low = LOWER[buf]
    inside = np.zeros(n + 1, bool)
    inside[:n] = table[low]
    first = inside[:n].copy()
    first[1:] &= ~inside[:n - 1]
    heads = offsets[:-1][offsets[:-1] < n]
    first[heads] |= inside[heads]                 # words do not run on into the next document
    last = inside[:n] & ~inside[1:]
    ends = offsets[1:][(offsets[1:] > 0)] - 1
    last[ends] |= inside[ends]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUE[low] * power[:n], out=sums[1:])
    h = mixed((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64) * MIX[2])
    at = np.searchsorted(start, offsets)
    return h, np.diff(at)


def shingles(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the k-word shingles; fewer words, but some, make one of them all."""
    ends = np.cumsum(counts)
    n = len(h)
    if n >= k:
        s = h[:n - k + 1] * MIX[3]
        for j in range(1, k):
            s = mixed(s + h[j:n - k + 1 + j]) * MIX[3]
        s = mixed(s)
    else:
        s = np.empty(0, np.uint64)
    # a shingle belongs to a document if it starts k - 1 words before its end at the latest
    keep = np.zeros(len(s) + 1, np.int64)
    full = counts >= k
    np.add.at(keep, (ends - counts)[full], 1)
    np.add.at(keep, (ends - k + 1)[full], -1)
    s = s[np.cumsum(keep[:-1]) > 0]
    out = np.where(full, counts - k + 1, (counts > 0).astype(np.int64))
    short = np.flatnonzero((counts > 0) & ~full)
    if len(short):
        pos = (np.cumsum(out) - out)[short]
        one = np.empty(len(short), np.uint64)
        with np.errstate(over="ignore"):
            for x, d in enumerate(short):
                acc = np.uint64(int(counts[d]))
                for w in h[ends[d] - counts[d]:ends[d]]:
                    acc = mixed(acc * MIX[4] + w)
                one[x] = acc
        # places of the short documents among all shingles
        s = np.insert(s, pos - np.arange(len(short)), one)
    return s, out
