"""Word and shingle hashes of Arrow text columns, vectorised over whole batches.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  Bytes of UTF-8 above 0x7F
are never separators, so the work is done on the raw buffer.  A word's hash is a
polynomial over its bytes modulo 2**64, read from one running sum, then mixed; a shingle's
hash mixes the hashes of its words.  Two different shingles meet in one 64-bit hash with
a probability of about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
_SLICE_BYTES = 1_000_000
#: A slice's hashes take some fifty times its bytes while shingles are made of them.
_SHINGLE_BYTES = 200_000


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(_MIX[0])
    x ^= x >> np.uint64(33)
    x *= np.uint64(_MIX[1])
    x ^= x >> np.uint64(33)
    return x


def _powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006 - grows per process
    if cache.get("n", 0) < n:
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            cache[key] = np.cumprod(p, dtype=np.uint64)
        cache["n"] = n
    return cache["up"][:n], cache["down"][:n]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    gap = np.zeros(256, dtype=bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    return low, gap


def text_slices(column: pa.Array | pa.ChunkedArray, size: int = _SLICE_BYTES):
    """``(first row, offsets, bytes)`` for runs of rows of about ``size`` bytes; null counts as empty.
    A longer row is a run of its own: texts are never cut."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    row = 0
    for chunk in chunks:
        chunk = chunk.cast(pa.large_binary()).fill_null(b"")
        off = np.frombuffer(chunk.buffers()[1], dtype=np.int64)[chunk.offset:chunk.offset + len(chunk) + 1]
        data = chunk.buffers()[2]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        i = 0
        while i < len(chunk):
            j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
            yield row + i, off[i:j + 1] - off[i], data[off[i]:off[j]]
            i = j
        row += len(chunk)


def word_hashes(off: np.ndarray, data: np.ndarray, letters: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``(hash of each word, index of each row's first word)``; the index has one entry more.
    With ``letters``, ASCII characters other than letters and digits separate words too."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    low, gap = _tables()
    if letters:
        gap[:128] = True
        gap[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
    inside = ~gap[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[off] = True
    starts = np.flatnonzero(inside & (first[:-1] | ~np.r_[False, inside[:-1]]))
    ends = np.flatnonzero(inside & (first[1:] | ~np.r_[inside[1:], False])) + 1
    up, down = _powers(len(data) + 1)
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(low[data].astype(np.uint64) * up[:-1], out=run[1:])
    h = (run[ends] - run[starts]) * down[starts]
    h = mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return h, np.searchsorted(starts, off).astype(np.int64)


def shingle_sets(column, k: int):
    """``(row, sorted distinct shingle hashes)`` for every row of a text column.

    A row of fewer than ``k`` words, but some, has its whole word sequence as one
    shingle; a row without words, an empty text and null have none.
    """
    weights = [np.uint64(pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64)) for i in range(k)]
    for row, off, data in text_slices(column, _SHINGLE_BYTES):
        words, at = word_hashes(off, data)
        n = len(words) - k + 1
        joined = np.zeros(max(n, 0), dtype=np.uint64)
        if n > 0:
            for i, w in enumerate(weights):
                joined += words[i:i + n] * w
            joined = mix64(joined)
        for r in range(len(off) - 1):
            a, b = int(at[r]), int(at[r + 1])
            if b - a >= k:
                yield row + r, np.unique(joined[a:b - k + 1])
            elif b > a:
                s = np.array([b - a], dtype=np.uint64)
                for i in range(a, b):
                    s = mix64(s * weights[-1] + words[i:i + 1])
                yield row + r, s
            else:
                yield row + r, np.zeros(0, np.uint64)


def set_key(tokens: np.ndarray) -> int:
    """One signed 64-bit key of a set of hashes, the same for equal sets only (a wrong
    meeting has a probability of about 2**-64 a pair)."""
    a = mix64(tokens).sum(dtype=np.uint64)
    b = mix64(tokens ^ np.uint64(0x165667B19E3779F9)).sum(dtype=np.uint64)
    key = mix64(np.array([a ^ mix64(np.array([b + np.uint64(len(tokens))]))[0]], dtype=np.uint64))
    return int(key.view(np.int64)[0])
