"""Vectorised text kernels on Arrow buffers (no Spark import).

Texts are handled as the concatenated UTF-8 bytes of many rows, in slices of about
``SLICE_BYTES`` cut at row boundaries, so that memory stays level whatever the
batch holds. slices() makes one row longer than that a slice of its own; pieces()
also cuts within a row, before a word, so that a text of any length is worked on in
level memory (a single word of over a slice is the only thing never cut).

A *word* is a maximal run of ASCII letters, digits and non-ASCII bytes after
Unicode lower-casing. A null text counts as an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_NGRAM = 0xC2B2AE3D27D4EB4F

WORD_BYTE = np.zeros(256, np.bool_)
WORD_BYTE[ord("0") : ord("9") + 1] = True
WORD_BYTE[ord("a") : ord("z") + 1] = True
WORD_BYTE[ord("A") : ord("Z") + 1] = True
WORD_BYTE[128:] = True

_powers: dict[int, np.ndarray] = {}


def _pow_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the longest table made is kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 1))
        with np.errstate(over="ignore"):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            have = np.multiply.accumulate(steps)
        if n <= 8 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def as_array(col) -> pa.Array:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks)
    return col


def raw_text(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    arr = as_array(col)
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    arr = arr.cast(pa.large_string())
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    base, end = (int(offsets[0]), int(offsets[-1]))
    body = np.frombuffer(data, np.uint8)[base:end] if data is not None and end > base else np.zeros(0, np.uint8)
    return body, offsets - base


def slices(col, lower: bool = True, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of each slice."""
    arr = as_array(col)
    if lower:
        arr = pc.utf8_lower(arr)
    body, offsets = raw_text(arr)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def pieces(col, lower: bool = True, size: int = SLICE_BYTES, marks: np.ndarray = WORD_BYTE, back: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """(first row, row after the last, bytes, offsets, byte of the row at which the piece starts).

    Rows up to ``size`` bytes come as in slices(), with 0 as the last value. A longer row comes as several pieces in order, each
    cut before a word (the first of a run of bytes in ``marks``); each after the first goes back over the last ``back`` words of the
    one before. No piece of a long row is empty, and the words of all pieces, without those gone over again, are the row's words.
    """
    for i, j, body, offsets in slices(col, lower, size):
        n = len(body)
        if j - i > 1 or n <= 2 * size:
            yield i, j, body, offsets, 0
            continue
        lo = 0
        while lo < n:
            hi, starts = lo, np.zeros(0, np.int64)
            while hi < n and len(starts) <= back:  # a piece that holds no more than it goes back over gets longer
                hi = _word_start(body, hi + size, marks) if hi + size < n else n
                head = marks[body[lo:hi]]
                head[1:] &= ~head[:-1]
                starts = np.flatnonzero(head)
            yield i, j, body[lo:hi], np.array([0, hi - lo]), lo
            if hi >= n:
                break
            lo = lo + int(starts[-back]) if back else hi


def _word_start(body: np.ndarray, at: int, marks: np.ndarray) -> int:
    """The first byte from at on where a word of marks starts, or the end."""
    step = 1 << 16
    while at < len(body):
        some = marks[body[max(at - 1, 0) : at + step]]
        found = np.flatnonzero(some[1:] & ~some[:-1])
        if len(found):
            return at + int(found[0])
        at += step
    return len(body)


def words(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each word; words never cross rows."""
    n = len(body)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    is_word = WORD_BYTE[body]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < n]
    first[inner] = is_word[inner]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:]
    before = inner[inner > 0] - 1
    last[before] = is_word[before]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def prefix_hash(body: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums; span_hash() takes any span's hash from them."""
    out = np.zeros(len(body) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((body.astype(np.uint64) + np.uint64(1)) * _pow_table(_BASE, len(body)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; equal bytes give equal hashes wherever they stand."""
    with np.errstate(over="ignore"):
        h = (prefix[end] - prefix[start]) * _pow_table(_BASE_INV, len(prefix))[start]
        return mix64(h + (end - start).astype(np.uint64))


def ngram_hash(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of each n consecutive words of one row."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(h) - n + 1
    with np.errstate(over="ignore"):
        g = h[:m].copy()
        for k in range(1, n):
            g = g * np.uint64(_NGRAM) + h[k : k + m]
    at = np.flatnonzero(row[:m] == row[n - 1 :])
    return mix64(g[at]), at


def word_hashes(text: str) -> np.ndarray:
    """Hashes of one text's words, as the column kernels give them."""
    body, offsets = raw_text(pc.utf8_lower(pa.array([text or ""], pa.string())))
    s, e, _ = words(body, offsets)
    return span_hash(prefix_hash(body), s, e)


def bit_counts(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(features with each of the 64 bits set, features) of each row, highest bit first. row must be sorted."""
    ones, total = np.zeros((rows, 64), np.int64), np.zeros(rows, np.int64)
    step = 1 << 16
    for a in range(0, len(h), step):  # features in groups of 65536, for memory
        r = row[a : a + step]
        bits = np.unpackbits(h[a : a + step].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        head = np.flatnonzero(np.diff(r, prepend=-1))
        ones[r[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int64)
        total[r[head]] += np.diff([*head, len(r)])
    return ones, total


def majority(ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Charikar signature: the bits that more than half of a row's features have; 0 where a row has none."""
    weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    return ((ones * 2 > total[:, None]) * weights).sum(axis=1, dtype=np.uint64)


def simhash64(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Charikar signature of each row's multiset of 64-bit features. row must be sorted."""
    return majority(*bit_counts(h, row, rows))
