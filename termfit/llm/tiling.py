"""Benchmark decontamination by greedy string tiling.

Every task looks the word runs of its documents up among the benchmark's seeds (runs of
``min_match`` words), so a document is never moved and no bucket of documents is formed.
A pair of document and test item whose shared seeds could cover enough of the item is
tiled: a running Karp-Rabin hash finds the longest runs of unmarked words that both
share, these are marked, and the search length is lowered until it reaches
``min_match``. Tiles may lie in any order, so reordered passages are caught. An item
counts as leaked when its tiles cover ``threshold`` of its words.

The benchmark is sent to the tasks in blocks of a bounded size; a larger benchmark takes
more passes over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from termfit.llm.words import Words, mix, shingles, slices, words

MIN_MATCH = 5
THRESHOLD = 0.6
#: Benchmark text that one pass over the documents carries to every task.
BLOCK_BYTES = 8 << 20

_BASE = 0x9E3779B97F4A7C15 | 5


class _Runs:
    """Karp-Rabin keys of all runs of a sequence, for any length."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        power = np.full(len(keys) + 1, _BASE, np.uint64)
        back = np.full(len(keys) + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        power[0] = back[0] = 1
        self.back = np.multiply.accumulate(back)
        self.sums = np.zeros(len(keys) + 1, np.uint64)
        np.cumsum(mix(keys) * np.multiply.accumulate(power)[:-1], out=self.sums[1:])

    def of(self, length: int, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, key) of the runs of ``length`` words without a marked one."""
        before = np.concatenate([[0], np.cumsum(marked)])
        start = np.flatnonzero(before[length:] == before[: len(before) - length])
        return start, (self.sums[start + length] - self.sums[start]) * self.back[start]


def greedy_tiles(item: np.ndarray, text: np.ndarray, least: int, free: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in text, length) of two key sequences, longest first.

    ``free`` tells which words of the text may be used. Of equally long matches the one
    that starts first in the item, then in the text, is marked first.
    """
    item_marks = np.zeros(len(item), bool)
    text_marks = np.zeros(len(text), bool) if free is None else ~free
    item_runs, text_runs = _Runs(item), _Runs(text)
    length, tiles = min(len(item), len(text)), []
    if length < least:
        return tiles

    def longest(i: int, j: int) -> int:
        end = min(len(item) - i, len(text) - j)
        bad = (item[i : i + end] != text[j : j + end]) | item_marks[i : i + end] | text_marks[j : j + end]
        return int(bad.argmax()) if bad.any() else end

    length = min(length, max(20, least))
    while True:
        starts, keys = item_runs.of(length, item_marks)
        order = np.argsort(keys, kind="stable")
        starts, keys = starts[order], keys[order]
        places, wanted = text_runs.of(length, text_marks)
        low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
        found = []
        for at in np.flatnonzero(high > low):
            j = int(places[at])
            for i in map(int, starts[low[at] : high[at]]):
                inner = i and j and item[i - 1] == text[j - 1] and not item_marks[i - 1] and not text_marks[j - 1]
                if not inner and (n := longest(i, j)) >= length:
                    found.append((-n, i, j))
        found.sort()
        if found and -found[0][0] > 2 * length:
            length = -found[0][0]
            continue
        again = False
        for n, i, j in found:
            if not item_marks[i : i - n].any() and not text_marks[j : j - n].any():
                item_marks[i : i - n] = True
                text_marks[j : j - n] = True
                tiles.append((i, j, -n))
            else:
                again = True  # what is left of an overlapped match may still be long enough
        if again:
            continue
        if length == least:
            return tiles
        length = max(least, length // 2)


class Benchmark:
    """A block of test items with an index of their seeds."""

    def __init__(self, ids: list, texts: list, min_match: int, threshold: float):
        self.ids, self.min_match, self.threshold = ids, min_match, threshold
        found = words(pa.array(texts, pa.string()))
        ends = np.cumsum(found.count)
        self.items = [found.key[end - n : end] for n, end in zip(found.count, ends, strict=True)]
        row, at, key = shingles(found, min_match)
        use = found.count[row] >= min_match
        row, at, key = row[use], at[use] - (ends - found.count)[row[use]], key[use]
        order = np.argsort(key, kind="stable")
        self.item, self.at, key = row[order], at[order], key[order]
        self.seeds, self.first = np.unique(key, return_index=True)
        self.last = np.append(self.first[1:], len(key))
        bits = max(16, int(np.ceil(np.log2(len(key) + 1))) + 6)
        self.mask = np.uint64((1 << bits) - 1)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[(self.seeds & self.mask).astype(np.int64)] = True

    def leaks(self, found: Words) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """(row, item, tiles) of every leaked item in a slice of documents."""
        row, at, key = shingles(found, self.min_match)
        hit = np.flatnonzero(self.maybe[(key & self.mask).astype(np.int64)])
        if not len(hit) or not len(self.seeds):
            return
        seed = np.minimum(np.searchsorted(self.seeds, key[hit]), len(self.seeds) - 1)
        real = self.seeds[seed] == key[hit]
        hit, seed = hit[real], seed[real]
        order = np.argsort(row[hit], kind="stable")
        hit, seed = hit[order], seed[order]
        starts = np.cumsum(found.count) - found.count
        for r in np.unique(row[hit]):
            mine = slice(*np.searchsorted(row[hit], [r, r + 1]))
            begin, n = starts[r], found.count[r]
            free = np.zeros(n, bool)
            for k in range(self.min_match):
                free[at[hit[mine]] - begin + k] = True
            distinct = np.unique(seed[mine])
            spots = np.concatenate([np.arange(self.first[s], self.last[s]) for s in distinct])
            for item in np.unique(self.item[spots]):
                words_of_item = self.items[item]
                cover = np.zeros(len(words_of_item), bool)
                for k in range(self.min_match):
                    cover[self.at[spots[self.item[spots] == item]] + k] = True
                if cover.sum() < self.threshold * len(cover):
                    continue  # tiles cover no more than the shared seeds do
                tiles = greedy_tiles(words_of_item, found.key[begin : begin + n], self.min_match, free)
                if sum(t[2] for t in tiles) >= self.threshold * len(words_of_item):
                    yield int(r), int(item), tiles


def _blocks(benchmark: DataFrame, min_match: int, threshold: float, block_bytes: int) -> Iterator[Benchmark]:
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 32), F.lit(0))).first()[0]
    count = max(1, -(-size // block_bytes))
    for i in range(count):
        # Rows with one item_id go to one block.
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == i).orderBy("item_id", "text").collect()
        if rows:
            yield Benchmark([r[0] for r in rows], [r[1] for r in rows], min_match, threshold)


def leaked_items(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The test items that documents contain, in any order of their passages.

    ``docs`` has (doc_id, text), ``benchmark`` (item_id, text). Returns doc_id, item_id, item_words,
    covered_words, coverage and tiles (item_start, doc_start, length: in words), one row
    per leaking document row and item row. A null or empty text has no words and leaks nothing;
    an item of fewer than ``min_match`` words is too short to be told from chance and is
    never found. Repeated rows are reported one by one.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    tile = "array<struct<item_start:bigint,doc_start:bigint,length:bigint>>"
    schema = f"doc_id {id_type}, item_id {item_type}, item_words bigint, covered_words bigint, coverage double, tiles {tile}"

    item_arrow = to_arrow_type(benchmark.schema["item_id"].dataType)

    def run(block: Benchmark):
        def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tile_type = pa.list_(pa.struct([("item_start", pa.int64()), ("doc_start", pa.int64()), ("length", pa.int64())]))
            for whole in batches:
                for batch in slices(whole):
                    rows = list(block.leaks(words(batch.column("text"))))
                    total = [len(block.items[i]) for _, i, _ in rows]
                    covered = [sum(t[2] for t in tiles) for *_, tiles in rows]
                    named = [
                        [dict(zip(("item_start", "doc_start", "length"), t, strict=True)) for t in tiles]
                        for *_, tiles in rows
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array([r for r, *_ in rows], pa.int64())),
                            pa.array([block.ids[i] for _, i, _ in rows], item_arrow),
                            pa.array(total, pa.int64()),
                            pa.array(covered, pa.int64()),
                            pa.array([c / t for c, t in zip(covered, total, strict=True)], pa.float64()),
                            pa.array(named, tile_type),
                        ],
                        ["doc_id", "item_id", "item_words", "covered_words", "coverage", "tiles"],
                    )

        return tiled

    parts = [docs.mapInArrow(run(block), schema) for block in _blocks(benchmark, min_match, threshold, block_bytes)]
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, parts)


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns. Rows stay where they are: no shuffle."""

    def run(block: Benchmark):
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole):
                    keep = np.ones(batch.num_rows, bool)
                    keep[[r for r, *_ in block.leaks(words(batch.column("text")))]] = False
                    yield batch.filter(pa.array(keep))

        return clean

    for block in _blocks(benchmark, min_match, threshold, block_bytes):
        docs = docs.mapInArrow(run(block), docs.schema)
    return docs
