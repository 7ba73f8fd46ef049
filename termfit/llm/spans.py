"""Tokens of Arrow text batches for any set of separating ASCII bytes, with 64-bit keys. Letters are kept as they are or folded.

UTF-8 bytes beyond ASCII never separate, so texts are cut without decoding. A token's key is a polynomial of
random byte values modulo 2**64, mixed; equal tokens have equal keys in every process.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from termfit.llm.words import HASH_BYTES, Words, byte_views, mix, salted

_BYTES = np.arange(256)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers = [np.ones(1, np.uint64)]


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 byte values lie in the ranges, ends included."""
    return np.logical_or.reduce([(_BYTES >= low) & (_BYTES <= high) for low, high in ranges])


def fold_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def _power_table(n: int) -> np.ndarray:
    if len(_powers[0]) < n:
        table = np.full(max(n, HASH_BYTES), _BASE, np.uint64)
        table[0] = 1
        _powers[0] = np.multiply.accumulate(table)
    return _powers[0]


def bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the maximal runs of ``inside`` bytes begin and end; none goes on into the next row."""
    held = np.zeros(len(data) + 1, bool)
    held[:-1] = inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begins = held.copy()
    begins[1:] &= ~held[:-1] | cut[1:]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = held[:-1] & (~held[1:] | cut[1:])
    return np.flatnonzero(begins), np.flatnonzero(ends)


def keys(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool, salt: int = 0) -> np.ndarray:
    """The keys of the tokens data[start:end], a bounded number of bytes at a time."""
    seen = fold_bytes(_BYTES) if fold else _BYTES
    values = salted(seen.astype(np.uint64) + np.uint64(1), 101 + salt)
    found = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        until = max(at + 1, int(np.searchsorted(end, start[at] + HASH_BYTES, side="right")))
        size = end[at:until] - start[at:until]
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        letters = data[place + np.repeat(start[at:until], size)]
        found[at:until] = mix(np.add.reduceat(values[letters] * _power_table(int(size.max()))[place], first))
        at = until
    return found


def tokens(texts: pa.Array, inside: np.ndarray, fold: bool) -> tuple[np.ndarray, Words]:
    """The bytes of all rows and the tokens in them."""
    data, offsets = byte_views(texts)
    start, end = bounds(data, offsets, inside)
    row = np.searchsorted(offsets, start, side="right") - 1
    return data, Words(row, start, end, keys(data, start, end, fold), np.bincount(row, minlength=len(offsets) - 1))
