"""Vectorised word splitting and n-gram hashing over Arrow text columns.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text.
Hashes are polynomial sums modulo 2**64 over random byte values, finished by a mixer.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

U = np.uint64
_RNG = np.random.default_rng(20240229)
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD_BASE, GRAM_BASE_A, GRAM_BASE_B = 0x9E3779B97F4A7C13, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4B
SLICE = 1 << 19


@functools.lru_cache(maxsize=16)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base % 2**64, 1 << max(10, int(n).bit_length()))[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U(33)
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its n+1 offsets; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string()).cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's first word (n+1 values)."""
    return runs(~SPACE[data], offsets)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are ``inside``, cut where texts end, and
    each text's first run (n+1 values)."""
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < len(inside)]
    opens[heads] |= inside[heads]
    tails = offsets[1:][offsets[1:] > 0] - 1
    closes[tails] |= inside[tails]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    lens = ends - starts
    cum = np.concatenate([[0], np.cumsum(lens)])
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(cum, cum[lo] + SLICE)))
        hi = min(hi, len(starts))
        n, first = lens[lo:hi], cum[lo:hi] - cum[lo]
        at = np.arange(cum[hi] - cum[lo]) - np.repeat(first, n)
        values = BYTE_VALUES[data[np.repeat(starts[lo:hi], n) + at]] * powers(WORD_BASE, int(n.max()))[at]
        out[lo:hi] = np.add.reduceat(values, first)
        lo = hi
    return mix(out)


def grams(hashes: np.ndarray, n: int, base: int = GRAM_BASE_A) -> np.ndarray:
    """Hash of each n consecutive values (across text ends, too: mask with ``fits``)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    k = len(hashes)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(base, k), dtype=np.uint64)])
    back = powers(pow(base, -1, 2**64), k)[: k - n + 1]
    return mix((total[n:] - total[:-n]) * back + U(n))


def spans(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int) -> np.ndarray:
    """Hash of hashes[lo:hi] for each pair; depends on the values alone."""
    k = len(hashes)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(base, max(k, 1))[:k], dtype=np.uint64)])
    back = powers(pow(base, -1, 2**64), k + 1)
    return mix((total[hi] - total[lo]) * back[lo] + (hi - lo).astype(np.uint64) * U(0x9E3779B97F4A7C15))


def fits(first: np.ndarray, n: int) -> np.ndarray:
    """For each word: do n words from it on lie in its own text? ``first`` from ``split``."""
    ends = np.repeat(first[1:], np.diff(first))
    return np.arange(len(ends)) + n <= ends


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
