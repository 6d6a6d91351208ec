"""Vectorised word hashing over Arrow string buffers (no per-word Python objects)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(0x5EED)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
MIX = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Upper-case ASCII letters map to lower case; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Separators of `[^\x20\x09-\x0D]+` and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing.
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
NON_ALNUM = np.zeros(256, dtype=bool)
NON_ALNUM[0x00:0x30] = NON_ALNUM[0x3A:0x61] = NON_ALNUM[0x7B:0x80] = True

CHUNK = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Murmur3's finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK)
        for k, p in enumerate((_P, _P_INV)):
            _powers[k] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, p)]), dtype=np.uint64)
    return _powers[0], _powers[1]


def _hash_words(buf: np.ndarray, breaks: np.ndarray, sep: np.ndarray, prefix: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of ``buf`` and the places of their first bytes; ``breaks`` are offsets that no
    word crosses. With a prefix, a second row of hashes is of the words' first so many bytes."""
    n = len(buf)
    if not n:
        return np.zeros((2, 0) if prefix else 0, np.uint64), np.zeros(0, np.int64)
    x = LOWER[buf]
    inside = ~sep[x]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = breaks[(breaks > 0) & (breaks < n)]
    first[cut] |= inside[cut]
    starts = np.flatnonzero(first)
    last = inside
    last = last.copy()
    last[:-1] &= ~inside[1:]
    last[cut - 1] |= inside[cut - 1]
    ends = np.flatnonzero(last)
    up, down = _power_tables(n + 1)
    acc = np.empty(n + 1, np.uint64)
    acc[0] = 0
    np.cumsum(_BYTE[x] * up[:n], out=acc[1:])

    def of(ends: np.ndarray) -> np.ndarray:
        return mix64((acc[ends + 1] - acc[starts]) * down[starts] + (ends - starts + 1).astype(np.uint64) * MIX[63])

    return np.stack([of(ends), of(np.minimum(ends, starts + prefix - 1))]) if prefix else of(ends), starts


def _pieces(buf: np.ndarray, sep: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts of about CHUNK bytes that end at a separator."""
    at = 0
    while at < len(buf):
        to = min(len(buf), at + CHUNK)
        while to < len(buf):
            gaps = np.flatnonzero(sep[LOWER[buf[to : to + CHUNK]]])
            if len(gaps):
                to += int(gaps[0])
                break
            to = min(len(buf), to + CHUNK)
        yield buf[at:to]
        at = to


def words_of(text: str | bytes | None, sep: np.ndarray) -> np.ndarray:
    """Word hashes of one text."""
    data = (text or "").encode() if not isinstance(text, bytes) else text
    buf = np.frombuffer(data, np.uint8)
    parts = [_hash_words(p, np.zeros(0, np.int64), sep)[0] for p in _pieces(buf, sep)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def batches_of_words(column: pa.Array, sep: np.ndarray, prefix: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, offsets by row) over an Arrow string column; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + CHUNK, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        a, b = int(offsets[lo]), int(offsets[hi])
        if hi == lo + 1 and b - a > CHUNK:
            parts = [_hash_words(p, np.zeros(0, np.int64), sep, prefix)[0] for p in _pieces(data[a:b], sep)]
            h = np.concatenate(parts, axis=-1)
            yield lo, hi, h, np.array([0, h.shape[-1]])
        else:
            rel = offsets[lo : hi + 1] - a
            h, starts = _hash_words(data[a:b], rel, sep, prefix)
            yield lo, hi, h, np.searchsorted(starts, rel)
        lo = hi


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each run of n consecutive words."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    m = len(h) - n + 1
    out = h[:m] * MIX[0]
    for k in range(1, n):
        out = out + h[k : k + m] * MIX[k]
    return mix64(out + np.uint64(n * int(MIX[62]) % 2**64))
