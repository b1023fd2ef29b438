"""Words and word shingles of whole texts as 64-bit hashes, in numpy over Arrow buffers.

Words are runs without the white space of ``SPACE``; A-Z count as a-z. A word's hash is a difference of prefix
sums of a polynomial over its bytes, so a batch of texts costs a few passes and no Python per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.Generator(np.random.PCG64(20240229))
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_TABLE[65:91] = _TABLE[97:123]
_PLACES = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h + np.uint64((0x632BE59BD9B4E019 * (seed + 1)) & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64, kept per worker."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK)
        both = []
        for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        _powers = (both[0], both[1])
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(data: np.ndarray, table: np.ndarray = _TABLE) -> np.ndarray:
    """S with S[0] = 0 and S[i + 1] = S[i] + table[data[i]] * base^i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], wherever the same bytes lie."""
    return (prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts]


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of texts of about ``CHUNK`` bytes, or one longer text. No nulls."""
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        yield at, raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, where each text's words begin, with an end)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    return mixed(span_hashes(prefix_hashes(data), starts, ends)), np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word runs; the hash of all words if there are fewer; none without words."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(k, n)
    total = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        total += hashes[j : n - size + 1 + j] * _PLACES[j % 16] ** np.uint64(1 + j // 16)
    return mixed(total)


def gram_batch(hashes: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """grams() of every text of a chunk at once: (hashes, where each text's begin, with an end)."""
    counts = np.diff(starts)
    short = (counts < k) & (counts > 0)
    made = np.where(counts >= k, counts - k + 1, short)
    out = np.zeros(int(made.sum()), np.uint64)
    begins = np.append(0, np.cumsum(made))
    if len(hashes) >= k:
        every = grams(hashes, k)
        owner = np.repeat(np.arange(len(counts)), np.where(counts >= k, made, 0))
        within = np.arange(len(owner)) - np.repeat(np.append(0, np.cumsum(np.where(counts >= k, made, 0)))[:-1], np.where(counts >= k, made, 0))
        out[begins[owner] + within] = every[starts[owner] + within]
    for i in np.flatnonzero(short):
        out[begins[i]] = grams(hashes[starts[i] : starts[i + 1]], k)[0]
    return out, begins
