"""Counting keys of whole texts across blocks of documents.

Documents lie in blocks. A block asks for its distinct 64-bit keys (sorted, cut into ranges that are the
same for all blocks, and packed), a range adds up what all blocks hold, and every block
gets the totals back in the order of its keys. A key that occurs everywhere is one entry per block,
and a block's keys never meet another block's texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes of a block, and of the share of the corpus that one range of keys stands for.
BLOCK_BYTES = 4 << 20
RANGE_BYTES = 16 << 20

ASKED = "range int, block bigint, keys binary, counts binary"
TOTALS = "range int, block bigint, totals binary"


def blocked(docs: DataFrame, *, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, int]:
    """``docs`` dealt into blocks by a hash of (doc_id, text), and the number of key ranges for their size."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    spread = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))
    return docs.withColumn("block", spread).repartition(blocks, "block"), max(1, -(-size // range_bytes))


def pack(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, so that small ones compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unpack(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def starts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range of keys begins in ascending keys, and their number at the end."""
    cuts = np.array([(i << 64) // ranges for i in range(ranges)], np.uint64)
    return np.append(np.searchsorted(keys, cuts), len(keys))


def ask(block: int, keys: np.ndarray, counts: np.ndarray, ranges: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Rows of ASKED for a block's distinct ascending keys; counts below 2**32."""
    at = starts(keys, ranges)
    counts = counts.astype(np.uint32)
    for i in range(ranges):
        if at[i] < at[i + 1]:
            part = slice(at[i], at[i + 1])
            yield i, block, pack_keys(keys[part]), pack(counts[part])


def table(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    return pa.table({name: pa.array(list(c), kind) for (name, kind), c in zip(kinds, columns, strict=True)})


ASKED_KINDS = [("range", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
TOTAL_KINDS = [("range", pa.int32()), ("block", pa.int64()), ("totals", pa.binary())]


def summed(asked: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(distinct keys, their totals, place of each asked key, keys per row) of one range."""
    parts = [unpack_keys(k) for k in asked.column("keys").to_pylist()]
    counts = np.concatenate([unpack(c, np.uint32) for c in asked.column("counts").to_pylist()])
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    totals = np.zeros(len(keys), np.int64)
    np.add.at(totals, place, counts.astype(np.int64))
    return keys, totals, place, [len(p) for p in parts]


def answer(most: int | None = None) -> Callable[[pa.Table], pa.Table]:
    """For ``asked.groupBy("range").applyInArrow``: the totals of every block's keys, as uint32, not above ``most``."""

    def run(asked: pa.Table) -> pa.Table:
        _, totals, place, sizes = summed(asked)
        found = np.minimum(totals, most or (1 << 32) - 1).astype(np.uint32)[place]
        ends = np.cumsum(sizes)
        ranges, blocks = asked.column("range").to_pylist(), asked.column("block").to_pylist()
        rows = [(r, b, pack(found[e - n : e])) for r, b, e, n in zip(ranges, blocks, ends, sizes, strict=True)]
        return table(rows, TOTAL_KINDS)

    return run


def answers(totals: pa.Table) -> np.ndarray:
    """A block's answers in the order of its ascending keys."""
    if not totals.num_rows:
        return np.empty(0, np.int64)
    ordered = totals.sort_by("range").column("totals").to_pylist()
    return np.concatenate([unpack(t, np.uint32) for t in ordered]).astype(np.int64)
