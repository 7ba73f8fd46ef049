"""Language-model scoring with a weighted backoff automaton over word bigrams.

States are the words seen in training (and the beginning of a text), arcs the bigrams
seen, and every state has a failure arc to the root, whose arcs are the smoothed
unigrams. With c(h) the count of the state's word and T(h) = c(h)**b the number of different
successors that Heaps' law expects (b from the corpus: log V / log N), the failure arc
weighs T / (c + T), and the arc of a seen bigram (1 - T / (c + T)) * c(hw) / c(h) plus what the
failure arc would give. The weights leaving a state add up to one.

Each block of documents asks for the counts of its own words and bigrams (see
``exchange``), so that the automaton is never gathered anywhere; a block walks the part that
its texts touch, from left to right, all its texts at once.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfit.llm import exchange
from termfit.llm.words import mix, salted, slices, words

#: Keys of the beginning and the end of a text.
BEGIN, END = np.uint64(0x5BD1E995A7C3F1B5), np.uint64(0xC2B2AE3D27D4EB4F)


def is_held_out(doc_id) -> bool:
    """crc32 of the id as text modulo 5 is 1; a missing id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


class _Walk:
    """The steps (state, token) of all texts of a table, and the keys of words and bigrams."""

    def __init__(self, docs: pa.Table | pa.RecordBatch):
        texts = docs.column("text")
        found = words(texts)
        rows = docs.num_rows
        n = found.count + 1  # and the end
        self.tokens_of = n
        self.row = np.repeat(np.arange(rows), n)
        ends = np.cumsum(n) - 1
        inner = np.ones(int(n.sum()), bool)
        inner[ends] = False
        token = np.full(len(inner), END, np.uint64)
        token[inner] = found.key
        state = np.empty_like(token)
        state[1:] = token[:-1]
        state[ends - n + 1] = BEGIN
        self.token, self.state = salted(token, 1), salted(state, 1)
        self.bigram = salted(mix(state) + token, 2)
        self.held_out = np.array([is_held_out(i) for i in docs.column("doc_id").to_pylist()], bool)
        self.first = np.zeros(len(inner), bool)
        self.first[ends - n + 1] = True

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct keys, place of each occurrence, weights): tokens, bigrams, then beginnings."""
        every = np.concatenate([self.token, self.bigram, self.state[self.first]])
        keys, place = np.unique(every, return_inverse=True)
        trains = ~self.held_out[np.concatenate([self.row, self.row, self.row[self.first]])]
        return keys, place, trains


def _vocabulary(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                walk = _Walk(batch)
                keys, counts = np.unique(walk.token[~walk.held_out[walk.row]], return_counts=True)
                yield from exchange.table(list(exchange.ask(0, keys, counts, ranges)), exchange.ASKED_KINDS).to_batches()

    return run


def _sizes(asked: pa.Table) -> pa.Table:
    keys, totals, _, _ = exchange.summed(asked)
    return pa.table({"n": pa.array([int(totals.sum())], pa.int64()), "v": pa.array([len(keys)], pa.int64())})


def _ask(ranges: int):
    def run(docs: pa.Table) -> pa.Table:
        keys, place, trains = _Walk(docs).keys()
        counts = np.bincount(place[trains], minlength=len(keys))
        return exchange.table(list(exchange.ask(docs.column("block")[0].as_py(), keys, counts, ranges)), exchange.ASKED_KINDS)

    return run


def _score(n: int, v: int):
    power = math.log(v) / math.log(n) if n > 1 and v > 1 else 1.0

    def run(docs: pa.Table, totals: pa.Table) -> pa.Table:
        walk = _Walk(docs)
        keys, place, _ = walk.keys()
        count = exchange.answers(totals)[place]
        steps = len(walk.token)
        known, pair = count[:steps], count[steps : 2 * steps]
        visits = np.empty(steps, np.int64)
        visits[1:] = known[:-1]
        visits[walk.first] = count[2 * steps :]
        root = (known + 0.5) / (n + 0.5 * (v + 1))
        seen = np.maximum(visits, 1)
        kinds = seen.astype(float) ** power
        fail = np.where(visits > 0, kinds / (seen + kinds), 1.0)
        weight = (1 - fail) * pair / seen + fail * root
        rows = docs.num_rows
        total = lambda x: np.bincount(walk.row, weights=x, minlength=rows)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": pa.array(walk.held_out),
                "n_tokens": pa.array(walk.tokens_of.astype(np.int64)),
                "n_known": pa.array(total(known > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(rows, n, np.int64)),
                "base_score": pa.array(total(np.log10(root))),
                "score": pa.array(total(np.log10(weight))),
            }
        )

    return run


def score(docs: DataFrame, *, block_bytes: int = exchange.BLOCK_BYTES, range_bytes: int = exchange.RANGE_BYTES) -> DataFrame:
    """log10 probabilities of every row of ``docs`` (doc_id, text), trained on the rows that are not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams only) and score. A
    null or empty text is one token, the end. Repeated rows count and are scored one by one; rows
    without doc_id are training rows. Without training rows every token has the same probability.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed, ranges = exchange.blocked(docs, block_bytes=block_bytes, range_bytes=range_bytes)
    seen = docs.mapInArrow(_vocabulary(ranges), exchange.ASKED)
    n, v = seen.groupBy("range").applyInArrow(_sizes, "n bigint, v bigint").agg(F.sum("n"), F.sum("v")).first()
    asked = placed.groupBy("block").applyInArrow(_ask(ranges), exchange.ASKED)
    totals = asked.groupBy("range").applyInArrow(exchange.answer(), exchange.TOTALS)
    return placed.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        _score(n or 0, v or 0),
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
