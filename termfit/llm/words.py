"""Words and word shingles of Arrow text batches as 64-bit keys, computed on whole byte buffers.

A word is ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. All separators are ASCII, so UTF-8
bytes can be cut without decoding. A word's key is a polynomial of random byte values modulo
2**64, mixed; equal words have equal keys in every process, and two given different words
share a key with a probability of about 2**-62.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once, unless a single row is longer.
SLICE_BYTES = 4 << 20
#: Bytes hashed at once inside a slice.
HASH_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 5
_U64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread uint64 values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    return mix(x + np.uint64(salt * 0xD1342543DE82EF95 & _U64))


def _lower(byte: np.ndarray) -> np.ndarray:
    return np.where((byte >= 65) & (byte <= 90), byte + 32, byte)


_BYTES = np.arange(256, dtype=np.uint64)
_VALUES = salted(_lower(_BYTES) + np.uint64(1), 77)
_IS_WORD = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i for i <= n."""
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = max(n, HASH_BYTES) + 1
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def byte_views(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows in one array, and where each row begins (n + 1 offsets). A null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds at most SLICE_BYTES of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    row = 0
    while row < batch.num_rows:
        before = ends[row - 1] if row else 0
        until = max(row + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(row, until - row)
        row = until


class Words(NamedTuple):
    row: np.ndarray  # of each word
    start: np.ndarray  # byte offset in the slice
    end: np.ndarray
    key: np.ndarray  # uint64
    count: np.ndarray  # words of each row


def words(texts: pa.Array) -> Words:
    data, offsets = byte_views(texts)
    rows = len(offsets) - 1
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IS_WORD[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:]
    start = np.flatnonzero(begins)
    stops = np.zeros(len(data) + 1, bool)
    stops[1:] = inside[:-1] & (~inside[1:] | cut[1:])
    end = np.flatnonzero(stops)
    row = np.searchsorted(offsets, start, side="right") - 1
    key = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        until = max(at + 1, int(np.searchsorted(end, start[at] + HASH_BYTES, side="right")))
        lo, hi = start[at], end[until - 1]
        up, down = _power_tables(hi - lo)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_VALUES[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        first, last = start[at:until] - lo, end[at:until] - lo
        key[at:until] = mix((sums[last] - sums[first]) * down[first])
        at = until
    return Words(row, start, end, key, np.bincount(row, minlength=rows))


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, index of the first word, key) of every run of ``size`` words.

    A row with fewer words gives its whole sequence as one shingle; a row without words none.
    """
    n = len(found.key)
    if n >= size:
        key = found.key[: n - size + 1].copy()
        for j in range(1, size):
            key = mix(key * np.uint64(0x2545F4914F6CDD1D) + found.key[j : n - size + 1 + j])
        whole = found.row[: n - size + 1] == found.row[size - 1 :]
        row, at, key = found.row[: n - size + 1][whole], np.flatnonzero(whole), key[whole]
    else:
        row, at, key = found.row[:0], np.empty(0, np.int64), found.key[:0]
    firsts = np.cumsum(found.count) - found.count
    short = [(row, at, key)]
    for length in range(1, size):
        rows = np.flatnonzero(found.count == length)
        if len(rows):
            k = found.key[firsts[rows]]
            for j in range(1, length):
                k = mix(k * np.uint64(0x2545F4914F6CDD1D) + found.key[firsts[rows] + j])
            short.append((rows, firsts[rows], salted(k, length)))
    return tuple(np.concatenate(parts) for parts in zip(*short, strict=True))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of each row's distinct shingles, ordered by row and key."""
    row, _, key = shingles(words(texts), size)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[new], key[new]


def lists(row: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    """Values grouped by ascending row as a list column."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
