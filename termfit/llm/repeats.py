"""Removal of repeated byte strings: every byte covered by a string of LENGTH bytes that also starts elsewhere.

Sorting all suffixes needs a tuple for each byte of the corpus. Here only anchored places are
compared first: a string's anchor is the gram with the smallest key inside it, so equal strings have equal
anchors. Strings whose anchor occurs once are unique; the others are induced from it in a second
round by their own keys. Both rounds go through ``exchange``: blocks of documents ask how often their
keys occur, and no two texts meet. A text that is an exact copy as a whole takes part in the second
round once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfit.llm import exchange
from termfit.llm.words import byte_views, mix, salted

LENGTH = 200

_BASE = 0x9E3779B97F4A7C15 | 5
#: Answers of the first round: the key occurs again; this block is the one that stands for a copied text.
AGAIN, OWNER = 2, 4


def _sliding(values: np.ndarray, width: int, better: np.ufunc) -> np.ndarray:
    """``better`` (minimum or maximum) over every run of ``width`` values, in two passes per block of ``width``."""
    n = len(values)
    if n < width:
        return values[:0]
    worst = np.uint64(0) if better is np.maximum else np.uint64(0xFFFFFFFFFFFFFFFF)
    padded = np.full(-(-n // width) * width, worst, np.uint64)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = better.accumulate(grid, axis=1).reshape(-1)
    behind = better.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return better(behind[: n - width + 1], ahead[width - 1 : n])


class _Strings:
    """Keys of a block's whole texts, anchors and strings."""

    def __init__(self, docs: pa.Table, length: int):
        self.length = length
        self.data, self.offsets = byte_views(docs.column("text"))
        self.sizes = np.diff(self.offsets)
        n = len(self.data)
        gram = length // 2
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        self.sums = np.zeros(n + 1, np.uint64)
        values = salted(np.arange(256, dtype=np.uint64), 31)
        np.cumsum(values[self.data] * power[:-1], out=self.sums[1:])
        power[:] = pow(_BASE, -1, 1 << 64)
        power[0] = 1
        self.back = np.multiply.accumulate(power)
        inside = np.zeros(n + 1, np.int32)  # where a string fits its text
        has = self.sizes >= length
        np.add.at(inside, self.offsets[:-1][has], 1)
        np.add.at(inside, self.offsets[1:][has] - length + 1, -1)
        self.fits = np.cumsum(inside)[: max(0, n - length + 1)] > 0
        raw = memoryview(np.ascontiguousarray(self.data))
        self.text_keys = np.array(
            [int.from_bytes(hashlib.blake2b(raw[a:b], digest_size=8).digest(), "little") for a, b in zip(self.offsets, self.offsets[1:], strict=False)],
            np.uint64,
        )
        if not len(self.fits):
            self.anchor, self.anchors = np.empty(0, np.uint64), np.empty(0, np.uint64)
            return
        grams = self._keys(gram, 1)
        self.anchor = _sliding(grams, length - gram + 1, np.minimum)  # of the string at each place
        offered = np.where(self.fits, self.anchor, np.uint64(0))
        width = length - gram
        around = np.concatenate([np.zeros(width, np.uint64), offered, np.zeros(width, np.uint64)])
        self.anchors = grams[_sliding(around, width + 1, np.maximum) == grams]

    def _keys(self, length: int, salt: int) -> np.ndarray:
        n = len(self.data) - length + 1
        return salted((self.sums[length:] - self.sums[:n]) * self.back[:n], salt)

    def first(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct keys of anchors and texts, their counts, place of each text's key)."""
        texts = salted(self.text_keys, 41)
        keys, place, counts = np.unique(np.concatenate([texts, self.anchors]), return_inverse=True, return_counts=True)
        return keys, counts, place[: len(texts)]

    def copied(self, told: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which texts are copies as a whole, and which of these don't stand for their text."""
        copied = (told[place] & AGAIN > 0) & (self.sizes >= self.length)
        new = np.zeros(len(place), bool)
        new[np.unique(place, return_index=True)[1]] = True
        return copied, copied & ~(new & (told[place] & OWNER > 0))

    def second(self, told: np.ndarray, keys: np.ndarray, silent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, keys) of the strings that may repeat."""
        open_ = self.fits.copy()
        for row in np.flatnonzero(silent):
            open_[self.offsets[row] : self.offsets[row + 1]] = False
        at = np.flatnonzero(open_)
        new = np.ones(len(at), bool)  # neighbours mostly share their anchor
        anchor = self.anchor[at]
        new[1:] = anchor[1:] != anchor[:-1]
        runs = told[np.searchsorted(keys, anchor[new])] & AGAIN > 0
        at = at[runs[np.cumsum(new) - 1]] if len(at) else at
        key = salted((self.sums[at + self.length] - self.sums[at]) * self.back[at], 2)
        return at, key


def _ask_first(length: int, ranges: int):
    def run(docs: pa.Table) -> pa.Table:
        keys, counts, _ = _Strings(docs, length).first()
        return exchange.table(list(exchange.ask(docs.column("block")[0].as_py(), keys, counts, ranges)), exchange.ASKED_KINDS)

    return run


def _answer_first(asked: pa.Table) -> pa.Table:
    asked = asked.sort_by("block")
    keys, totals, place, sizes = exchange.summed(asked)
    owner = np.zeros(len(place), np.uint32)
    owner[np.unique(place, return_index=True)[1]] = OWNER
    told = np.where(totals > 1, AGAIN, 0).astype(np.uint32)[place] + owner
    ends = np.cumsum(sizes)
    ranges, blocks = asked.column("range").to_pylist(), asked.column("block").to_pylist()
    rows = [(r, b, exchange.pack(told[e - n : e])) for r, b, e, n in zip(ranges, blocks, ends, sizes, strict=True)]
    return exchange.table(rows, exchange.TOTAL_KINDS)


def _ask_second(length: int, ranges: int):
    def run(docs: pa.Table, totals: pa.Table) -> pa.Table:
        strings = _Strings(docs, length)
        keys, _, place = strings.first()
        told = exchange.answers(totals)
        _, silent = strings.copied(told, place)
        _, key = strings.second(told, keys, silent)
        distinct, counts = np.unique(key, return_counts=True)
        rows = exchange.ask(docs.column("block")[0].as_py(), distinct, counts, ranges)
        return exchange.table(list(rows), exchange.ASKED_KINDS)

    return run


def _remove(length: int):
    def run(docs: pa.Table, both: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        strings = _Strings(docs, length)
        keys, _, place = strings.first()
        told = exchange.answers(both.filter(pc.equal(both.column("round"), 1)))
        copied, silent = strings.copied(told, place)
        at, key = strings.second(told, keys, silent)
        distinct, back = np.unique(key, return_inverse=True)
        totals = exchange.answers(both.filter(pc.equal(both.column("round"), 2)))
        repeats = at[totals[back] > 1] if len(at) else at
        change = np.zeros(len(strings.data) + 1, np.int32)
        np.add.at(change, repeats, 1)
        np.add.at(change, repeats + length, -1)
        gone = np.cumsum(change)[:-1] > 0
        rows = []
        for row, (a, b) in enumerate(zip(strings.offsets, strings.offsets[1:], strict=False)):
            if copied[row]:
                rows.append(([0], [b - a], b""))
                continue
            mask = np.concatenate([[False], gone[a:b], [False]])
            edges = np.flatnonzero(mask[1:] != mask[:-1])
            rows.append((edges[::2].tolist(), edges[1::2].tolist(), strings.data[a:b][~gone[a:b]].tobytes()))
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "n_bytes": pa.array(strings.sizes.astype(np.int64)),
                "starts": pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                "ends": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                "kept": pa.array([r[2] for r in rows], pa.binary()),
            }
        )

    return run


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    *,
    block_bytes: int = exchange.BLOCK_BYTES // 2,
    range_bytes: int = exchange.RANGE_BYTES // 4,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) without the bytes that a repeated string of ``length`` bytes covers.

    Returns doc_id, n_bytes, starts and ends of the removed runs (bytes) and kept, the remaining bytes. Strings
    never cross rows; a string that starts twice in one row repeats, even where the two overlap. A null
    text is empty. Rows that repeat, with or without the same doc_id, are copies of each other. Cuts
    may fall inside a character, so ``kept`` need not be valid UTF-8.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed, ranges = exchange.blocked(docs, block_bytes=block_bytes, range_bytes=range_bytes)
    one = placed.groupBy("block").applyInArrow(_ask_first(length, ranges), exchange.ASKED)
    one = one.groupBy("range").applyInArrow(_answer_first, exchange.TOTALS)
    two = placed.groupBy("block").cogroup(one.groupBy("block")).applyInArrow(_ask_second(length, ranges), exchange.ASKED)
    two = two.groupBy("range").applyInArrow(exchange.answer(2), exchange.TOTALS)
    both = one.withColumn("round", F.lit(1)).union(two.withColumn("round", F.lit(2)))
    return placed.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(
        _remove(length), f"doc_id {kind}, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary"
    )


def digests(removed: DataFrame) -> DataFrame:
    lengths = F.zip_with("starts", "ends", lambda a, b: b - a)
    return removed.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_removed"),
        F.size("starts").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
