"""Ranked lexical search: the documents with the largest inner product for every item, by norm buckets.

A document is the vector of its terms' impacts, restricted to the terms that some item holds, and an item the
vector of its terms' weights. Tasks order the vectors that they have read by length and cut them into buckets.
With the 50th best score found so far as a threshold, an item skips each bucket whose longest vector cannot reach
it (Cauchy-Schwarz). Inside a bucket the coordinates of the item's heaviest terms give a bound, those terms exactly and
all others by Cauchy-Schwarz again. What that bound leaves is scored in integers, so bounds decide about work and never about results.

Items travel in blocks of bounded text size; documents are read where they lie and nothing of them is
gathered but a task's best rows per item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termfit.llm.spans import byte_set, tokens
from termfit.llm.words import slices
from termfit.session import scratch_path

#: Text bytes of the items that travel to the tasks at once.
ITEM_BYTES = 1 << 20
#: Non-zero coordinates that a task gathers before it orders and searches them, and vectors of a bucket.
CHUNK = 4_000_000
BUCKET = 1024
#: Share of an item's squared length that its focus coordinates hold.
FOCUS = 0.7
#: Room for rounding in bounds, which are computed in doubles.
SLACK = 1 + 1e-9
BEST = 50

#: The bytes of a term are those outside these ranges.
TERM = ~byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

DOCUMENTS, TERMS = -1, -2


class Items(NamedTuple):
    """A block of items: their distinct terms as ascending keys, and each item's places in them."""

    keys: np.ndarray
    places: list[np.ndarray]


class Plan(NamedTuple):
    """What a task needs to search: the items with weights, and the corpus sizes."""

    items: Items
    weights: np.ndarray  # int64 for each term
    n: int
    total: int


def _items(texts: list[str]) -> Items:
    _, found = tokens(pa.array(texts, pa.string()), TERM, True)
    keys, place = np.unique(found.key, return_inverse=True)
    ends = np.cumsum(found.count)
    return Items(keys, [np.unique(place[e - c : e]) for e, c in zip(ends, found.count, strict=True)])


def _places(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the asked keys are there, and where."""
    place = np.searchsorted(keys, asked)
    place[place == len(keys)] = 0
    known = keys[place] == asked if len(keys) else np.zeros(len(asked), bool)
    return known, place


def _statistics(keys: np.ndarray):
    """(term, n): in how many documents each term is, the number of documents with terms and of all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        frequency = np.zeros(len(keys), np.int64)
        for whole in batches:
            for batch in slices(whole):
                _, found = tokens(batch.column("text"), TERM, True)
                documents += int((found.count > 0).sum())
                terms += len(found.key)
                known, place = _places(keys, found.key)
                once = np.unique(found.row[known] * len(keys) + place[known])
                frequency += np.bincount(once % max(len(keys), 1), minlength=len(keys))
        seen = np.flatnonzero(frequency)
        yield pa.record_batch(
            {
                "term": pa.array(np.append(seen, [DOCUMENTS, TERMS]), pa.int32()),
                "n": pa.array(np.append(frequency[seen], [documents, terms]), pa.int64()),
            }
        )

    return run


class _Vectors(NamedTuple):
    """Impact vectors of some documents by row and term; ``ids`` names the rows."""

    ids: list
    row: np.ndarray
    term: np.ndarray
    impact: np.ndarray


def _vectors(batch: pa.RecordBatch, plan: Plan) -> _Vectors:
    _, found = tokens(batch.column("text"), TERM, True)
    size = max(len(plan.items.keys), 1)
    known, place = _places(plan.items.keys, found.key)
    pairs, tf = np.unique(found.row[known] * size + place[known], return_counts=True)
    row, term = np.divmod(pairs, size)
    # Python's integers: 50 * n * N may pass 64 bits
    lengths = np.array([100 - 50 + (50 * int(n) * plan.n) // max(plan.total, 1) for n in found.count], np.int64)
    impact = (1_000_000_000 * tf) // (1000 * tf + 20 * lengths[row])
    return _Vectors(batch.column("doc_id").to_pylist(), row, term, impact)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions of all ranges one after the other, and the number of the range of each."""
    size = high - low
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + low[of], of


class _Search:
    """The best rows of each item among the vectors seen so far."""

    def __init__(self, plan: Plan):
        self.found = [[] for _ in plan.items.places]  # (score, doc_id), unordered, at most BEST
        self.least = np.ones(len(self.found))  # a score has to reach this
        self.focus, self.all = [], []
        norms, rests = [], []
        for places in plan.items.places:
            weight = plan.weights[places]
            places, weight = places[weight > 0], weight[weight > 0]
            heavy = np.argsort(-weight, kind="stable")
            squares = np.cumsum(weight[heavy].astype(float) ** 2)
            whole = squares[-1] if len(squares) else 0.0
            heads = heavy[: int(np.searchsorted(squares, FOCUS * whole)) + 1]
            self.focus.append((places[heads], weight[heads]))
            self.all.append((places, weight))
            norms.append(math.sqrt(whole))
            rests.append(math.sqrt(max(whole - (squares[len(heads) - 1] if len(heads) else 0.0), 0.0)))
        self.norm, self.rest = np.array(norms), rests

    def add(self, parts: list[_Vectors]) -> None:
        ids = [i for part in parts for i in part.ids]
        firsts = np.cumsum([0, *(len(part.ids) for part in parts)])
        row = np.concatenate([part.row + first for part, first in zip(parts, firsts[:-1], strict=True)])
        term = np.concatenate([part.term for part in parts])
        impact = np.concatenate([part.impact for part in parts])
        length = np.sqrt(np.bincount(row, weights=impact.astype(float) ** 2, minlength=len(ids)))
        order = np.argsort(-length, kind="stable")
        order = order[length[order] > 0]
        rank = np.full(len(ids), len(order))
        rank[order] = np.arange(len(order))
        place = rank[row]
        by = np.lexsort((term, place // BUCKET))
        place, term, impact = place[by], term[by], impact[by]
        cuts = np.searchsorted(place // BUCKET, np.arange(-(-len(order) // BUCKET) + 1))
        for number, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            first = number * BUCKET
            rows = order[first : first + BUCKET]
            self._bucket(ids, rows, length[rows], place[low:high] - first, term[low:high], impact[low:high])

    def _bucket(self, ids, rows, length, place, term, impact) -> None:
        for item in np.flatnonzero(self.norm * length[0] * SLACK >= self.least):
            terms, weight = self.focus[item]
            at, of = _ranges(np.searchsorted(term, terms), np.searchsorted(term, terms, side="right"))
            part = np.bincount(place[at], weights=weight[of] * impact[at].astype(float), minlength=len(rows))
            taken = np.bincount(place[at], weights=impact[at].astype(float) ** 2, minlength=len(rows))
            bound = part + self.rest[item] * np.sqrt(np.maximum(length**2 - taken, 0.0))
            left = bound * SLACK >= self.least[item]
            if left.any():
                self._rescore(item, ids, rows, left, place, term, impact)

    def _rescore(self, item, ids, rows, left, place, term, impact) -> None:
        terms, weight = self.all[item]
        at, of = _ranges(np.searchsorted(term, terms), np.searchsorted(term, terms, side="right"))
        of, at = of[left[place[at]]], at[left[place[at]]]
        score = np.zeros(len(rows), np.int64)
        np.add.at(score, place[at], weight[of] * impact[at])
        good = np.flatnonzero(score >= self.least[item])
        found = self.found[item] + [(int(score[i]), ids[rows[i]]) for i in good]
        if len(found) > BEST:
            found.sort(key=lambda f: (-f[0], f[1] is not None, f[1]))
            found = found[:BEST]
        self.found[item] = found
        if len(found) == BEST:
            self.least[item] = max(min(f[0] for f in found), 1)


def _search(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(plan)
        parts, size, kind = [], 0, None
        for whole in batches:
            kind = whole.schema.field("doc_id").type
            for batch in slices(whole):
                parts.append(_vectors(batch, plan))
                size += len(parts[-1].row)
                if size >= CHUNK:
                    search.add(parts)
                    parts, size = [], 0
        if parts:
            search.add(parts)
        if kind is not None:
            best = [(item, doc, score) for item, found in enumerate(search.found) for score, doc in found]
            columns = list(zip(*best, strict=True)) or [[], [], []]
            yield pa.record_batch(
                {
                    "item": pa.array(list(columns[0]), pa.int32()),
                    "doc_id": pa.array(list(columns[1]), kind),
                    "score": pa.array(list(columns[2]), pa.int64()),
                }
            )

    return run


def _search_block(docs: DataFrame, ids: list, texts: list[str], id_kind: str) -> DataFrame:
    spark = docs.sparkSession
    items = _items(texts)
    # at most the block's distinct terms and two more rows
    sums = dict(docs.select("text").mapInArrow(_statistics(items.keys), "term int, n bigint").groupBy("term").agg(F.sum("n")).collect())
    n, total = sums.get(DOCUMENTS, 0), sums.get(TERMS, 0)
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * sums.get(i, 0) + 1))) for i in range(len(items.keys))]
    plan = Plan(items, np.array(weights, np.int64), n, total)
    kind = docs.schema["doc_id"].dataType.simpleString()
    best = docs.select("doc_id", "text").mapInArrow(_search(plan), f"item int, doc_id {kind}, score bigint")
    first = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    # the best of some shares of the tasks, then the best of these
    best = best.withColumn("share", F.pmod(F.xxhash64("doc_id", "score"), F.lit(64)))
    for by in (["item", "share"], ["item"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*first))).where(F.col("rank") <= BEST)
    names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {id_kind}")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # one block's names


def search(docs: DataFrame, items: DataFrame, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the 50 best documents of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text).

    Only scores above 0 count; equal scores rank by ascending doc_id, a missing one first. A null text has no terms. Rows of
    ``docs`` that share a doc_id are ranked one by one. Equal rows of ``items`` are one item; different texts with one
    item_id are ranked each for itself. Further columns are ignored. Texts may be of any length: a text is cut in one piece, with some
    30 bytes of memory per byte. Terms are compared by 64-bit keys; with V item terms, a corpus of D distinct terms holds a false
    match with odds of D * V / 2**64.
    """
    spark = docs.sparkSession
    id_kind, kind = (t.schema[c].dataType.simpleString() for t, c in ((items, "item_id"), (docs, "doc_id")))
    items = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // item_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    path = scratch_path(spark, "ranked")
    for block in range(blocks):
        rows = items.where(F.col("block") == block).collect()  # about item_bytes of text
        if rows:
            found = _search_block(docs, [r.item_id for r in rows], [r.text for r in rows], id_kind)
            found.write.mode("append").parquet(path)
    schema = f"item_id {id_kind}, rank int, doc_id {kind}, score bigint"
    return spark.read.schema(schema).parquet(path) if size else spark.createDataFrame([], schema)
