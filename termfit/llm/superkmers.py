"""Removing repeated passages of words, by super-k-mer partitioning.

A window is WINDOW consecutive words; its minimiser is the run of GRAM words in it with the smallest hash. Consecutive
windows with one minimiser form a super-k-mer, which travels as one packed string to its minimiser's bucket. There
the strings are sorted by the place that they come from, their windows are ranked by sorting, and a window is a repeat if an equal
one came before. Equal windows have equal minimisers, so they meet in one bucket.

Two things are settled before any string travels. Blocks of documents first ask how often their minimisers
occur: a window whose minimiser occurs once is unique, so its string stays at home. And the strings of a minimiser that
occurs more than HOT times travel window by window, each to the bucket of its own words: a common passage may
put a minimiser into a third of all documents, but the copies of one window are one string per block. A string that a block holds twice
travels once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfit.llm.exchange import pack, pack_keys, unpack, unpack_keys
from termfit.llm.spans import byte_set, tokens
from termfit.llm.words import Words, mix, salted
from termfit.plans.joins import hot_keys
from termfit.session import durable

WINDOW = 20
GRAM = 6
#: Windows of a super-k-mer at most: those that one run of GRAM words lies in.
SHARED = WINDOW - GRAM + 1
#: A minimiser that occurs more often is divided further.
HOT = 4096
#: Text bytes of a block of documents, and those that one range of minimisers stands for.
BLOCK_BYTES = 8 << 20
RANGE_BYTES = 64 << 20

#: Words or strings whose letters are gathered at once.
GATHERED = 50_000

#: Words are divided by these bytes.
WORD = ~byte_set((0x20, 0x20), (0x09, 0x0D))
SPACE = ~byte_set((0x20, 0x20))

ASKED = "range int, block bigint, keys binary, counts binary"
TOTALS = "range int, block bigint, totals binary"


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _gathered(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of all stretches [low, low + size) one after the other."""
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)


class _Block:
    """The documents of a block in order, equal rows once, and their words."""

    def __init__(self, docs: pa.Table):
        order = pc.sort_indices(docs, sort_keys=[("doc_id", "ascending"), ("h", "ascending")], null_placement="at_start")
        docs = docs.take(order).combine_chunks()
        code = pc.dictionary_encode(docs.column("doc_id"), null_encoding="encode").combine_chunks().indices.to_numpy()
        h = docs.column("h").to_numpy()
        new = np.concatenate([[True], (code[1:] != code[:-1]) | (h[1:] != h[:-1])])
        self.copies = np.add.reduceat(docs.column("copies").to_numpy(), np.flatnonzero(new))
        self.docs = docs.filter(pa.array(new))
        self.block = docs.column("block")[0].as_py()
        self.data, self.words = tokens(self.docs.column("text"), WORD, False)
        self.first = np.cumsum(self.words.count) - self.words.count

    def joined(self, held: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All words, or those held, each with a space behind it, and where each begins (and the last one ends)."""
        start, size = self.words.start, self.words.end - self.words.start
        if held is not None:
            start, size = start[held], size[held]
        offsets = np.concatenate([[0], np.cumsum(size + 1)])
        letters = np.full(int(offsets[-1]), 0x20, np.uint8)
        for at in range(0, len(size), GATHERED):
            part = slice(at, at + GATHERED)
            letters[_gathered(offsets[:-1][part], size[part])] = self.data[_gathered(start[part], size[part])]
        return letters, offsets

    def coded(self) -> np.ndarray:
        """A number for every word, equal for equal words."""
        letters, offsets = self.joined()
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)]
        ).dictionary_encode().indices.to_numpy()


def _strings(letters: np.ndarray, low: np.ndarray, size: np.ndarray) -> pa.Array:
    """The stretches [low, low + size) of ``letters``."""
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    found = np.empty(int(offsets[-1]), np.uint8)
    for at in range(0, len(size), GATHERED):
        part = slice(at, at + GATHERED)
        found[offsets[at] : offsets[min(at + GATHERED, len(size))]] = letters[_gathered(low[part], size[part])]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(found)])


def _sent_before(block: _Block, first: np.ndarray, n: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which strings (windows n from word ``first`` on) equal an earlier one of the block. ``keys`` only narrow down; words decide."""
    _, earliest, place = np.unique(keys, return_index=True, return_inverse=True)
    like = earliest[place]
    rest = np.flatnonzero(like != np.arange(len(first)))
    rest = rest[n[rest] == n[like[rest]]]
    code = block.coded() if len(rest) else None
    for k in range(WINDOW + SHARED - 1):
        within = k < n[rest] + WINDOW - 1
        same = ~within
        same[within] = code[first[rest[within]] + k] == code[first[like[rest[within]]] + k] if len(rest) else True
        rest = rest[same]
    before = np.zeros(len(first), bool)
    before[rest] = True
    return before


def _grams(words: Words) -> np.ndarray:
    key = words.key[: len(words.key) - GRAM + 1].copy()
    for k in range(1, GRAM):
        key = mix(key * np.uint64(0x2545F4914F6CDD1D) + words.key[k : len(words.key) - GRAM + 1 + k])
    return key


class _Runs:
    """The super-k-mers of a block: word of the first window, number of windows, minimiser."""

    def __init__(self, words: Words):
        empty = np.empty(0, np.int64)
        self.first, self.n, self.key, self.grams = empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
        windows = len(words.key) - WINDOW + 1
        if windows <= 0:
            return
        self.grams = grams = _grams(words)
        least = np.arange(len(grams))  # the leftmost smallest of ever more neighbours
        width = 1
        while width < SHARED:
            step = min(width, SHARED - width)
            left, right = least[:-step], least[step:]
            least = np.where(grams[right] < grams[left], right, left)
            width += step
        at = np.flatnonzero(words.row[:windows] == words.row[WINDOW - 1 :])
        least = least[at]
        starts = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1])])) if len(at) else empty
        self.first = at[starts]
        self.n = np.diff(np.append(starts, len(at)))
        self.key = salted(grams[least[starts]], 3)

    def window_keys(self, at: np.ndarray) -> np.ndarray:
        """A key of the words of the windows that begin at the given words."""
        key = self.grams[at].copy()
        for by in (*range(GRAM, WINDOW - GRAM, GRAM), WINDOW - GRAM):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + self.grams[at + by])
        return salted(key, 5)


def _ask(ranges: int):
    def run(docs: pa.Table) -> pa.Table:
        block = _Block(docs)
        keys, counts = np.unique(_Runs(block.words).key, return_counts=True)
        to = _range_of(keys, ranges)
        cuts = np.flatnonzero(np.diff(to, prepend=-1))
        parts = [slice(a, b) for a, b in zip(cuts, np.append(cuts, len(keys))[1:], strict=True)]
        return pa.table(
            {
                "range": pa.array(to[cuts], pa.int32()),
                "block": pa.array([block.block] * len(parts), pa.int64()),
                "keys": pa.array([pack_keys(keys[p]) for p in parts], pa.binary()),
                "counts": pa.array([pack(counts[p].astype(np.int64)) for p in parts], pa.binary()),
            }
        )

    return run


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Ascending ranges of ascending keys."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _answer(hot: int):
    """How often each asked minimiser occurs in all blocks, as far as it matters: once, more often, or too often."""

    def run(asked: pa.Table) -> pa.Table:
        parts = [unpack_keys(k) for k in asked.column("keys").to_pylist()]
        counts = np.concatenate([unpack(c, np.int64) for c in asked.column("counts").to_pylist()])
        keys, place = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.zeros(len(keys), np.int64)
        np.add.at(totals, place, counts)
        grade = ((totals > 1).astype(np.uint8) + (totals > hot))[place]
        ends = np.cumsum([len(p) for p in parts])
        packed = [grade[e - len(p) : e].tobytes() for p, e in zip(parts, ends, strict=True)]
        return asked.select(["range", "block"]).append_column("totals", pa.array(packed, pa.binary()))

    return run


def _packed_schema(kind: str) -> str:
    return f"key bigint, doc_id {kind}, h bigint, start int, n int, block bigint, ord int, words binary"


def _pack(docs: pa.Table, totals: pa.Table) -> pa.Table:
    """The block's super-k-mers whose minimiser occurs elsewhere; null for a string that the block has sent already."""
    if not docs.num_rows:
        raise ValueError("answers without their block")
    block = _Block(docs)
    runs = _Runs(block.words)
    keys, place = np.unique(runs.key, return_inverse=True)
    answers = b"".join(totals.sort_by("range").column("totals").to_pylist()) if totals.num_rows else b""
    grade = np.frombuffer(answers, np.uint8)[place] if len(keys) else np.empty(0, np.uint8)
    some, many = grade == 1, np.flatnonzero(grade == 2)
    single = _gathered(runs.first[many], runs.n[many])
    first = np.concatenate([runs.first[some], single])
    n = np.concatenate([runs.n[some], np.ones(len(single), np.int64)])
    key = np.concatenate([runs.key[some], runs.window_keys(single) if len(single) else runs.key[:0]])
    order = np.argsort(first, kind="stable")
    first, n, key = first[order], n[order], key[order]
    ends = runs.window_keys(first + n - 1) if len(first) else key
    sent = ~_sent_before(block, first, n, mix(key + ends * np.uint64(0xD1342543DE82EF95) + n.astype(np.uint64)))
    letters, offsets = block.joined()
    size = np.where(sent, offsets[first + n + WINDOW - 1] - offsets[first] - 1, 0)
    strings = _strings(letters, offsets[first], size).cast(pa.binary())
    row = block.words.row[first]
    return pa.table(
        {
            "key": pa.array(key.view(np.int64)),
            "doc_id": block.docs.column("doc_id").take(pa.array(row)),
            "h": block.docs.column("h").take(pa.array(row)),
            "start": pa.array(first - block.first[row], pa.int32()),
            "n": pa.array(n, pa.int32()),
            "block": pa.array(np.full(len(first), block.block), pa.int64()),
            "ord": pa.array(row, pa.int32()),
            "words": pc.if_else(pa.array(sent), strings, pa.scalar(None, pa.binary())),
        }
    )


def _window_ranks(word: np.ndarray) -> np.ndarray:
    """Equal numbers for equal windows of coded words, by sorting ever longer runs."""

    def both(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        base = int(right.max()) + 1
        return np.unique(left * base + right, return_inverse=True)[1]

    rank, length, taken = word, 1, None
    tail = 0  # words of the window behind the longest power of two
    steps = {1: word}
    while 2 * length <= WINDOW:
        rank = both(rank[: len(rank) - length], rank[length:])
        length *= 2
        steps[length] = rank
    taken, tail = length, WINDOW - length
    while tail:
        part = 1 << (tail.bit_length() - 1)
        more = steps[part][taken:]
        rank = both(rank[: len(more)], more[: len(rank)])
        taken, tail = taken + part, tail - part
    return rank


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which windows of sorted packed strings came before in their bucket, as one bit per window.

    Batches follow one another in the order of (key, place); what a bucket has shown so far is kept, each string once.
    """
    seen = None
    for batch in batches:
        sent = batch.filter(pc.is_valid(batch.column("words")))
        mask = (1 << batch.column("n").to_numpy().astype(np.int64)) - 1
        if sent.num_rows:
            columns = pa.Table.from_batches([sent]).select(["key", "n", "words"])
            before = 0 if seen is None else seen.num_rows
            table = columns if seen is None else pa.concat_tables([seen, columns]).combine_chunks()
            first_seen = _first_seen(table)
            mask[np.flatnonzero(pc.is_valid(batch.column("words")).to_numpy(zero_copy_only=False))] = first_seen[before:]
            last = table.filter(pc.equal(table.column("key"), table.column("key")[-1]))
            code = last.column("words").combine_chunks().dictionary_encode().indices.to_numpy()
            seen = last.take(pa.array(np.sort(np.unique(code, return_index=True)[1])))
        yield pa.record_batch({**{c: batch.column(c) for c in ("block", "ord", "start")}, "mask": pa.array(mask, pa.int32())})


def _first_seen(table: pa.Table) -> np.ndarray:
    """For each string the bits of its windows that an earlier window of its key equals."""
    strings = table.column("words").combine_chunks()
    data, words = tokens(strings.cast(pa.large_binary()).view(pa.large_string()), SPACE, False)
    letters = data[SPACE[data]]
    size = words.end - words.start
    coded = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(letters)]
    ).dictionary_encode()
    rank = _window_ranks(coded.indices.to_numpy().astype(np.int64))
    n = table.column("n").to_numpy().astype(np.int64)
    at = _gathered(np.cumsum(words.count) - words.count, n)
    of = np.repeat(np.arange(len(n)), n)
    key = np.unique(table.column("key").to_numpy(), return_inverse=True)[1]
    window = key[of] * (int(rank.max()) + 1) + rank[at]
    _, first, place = np.unique(window, return_index=True, return_inverse=True)
    repeat = first[place] != np.arange(len(window))
    bits = repeat.astype(np.int64) << (np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n))
    return np.add.reduceat(bits, np.cumsum(n) - n)


def _remove(docs: pa.Table, marks: pa.Table) -> pa.Table:
    block = _Block(docs)
    words, total = block.words, len(block.words.key)
    edge = np.zeros(total + 1, np.int64)
    if marks.num_rows:
        first = block.first[marks.column("ord").to_numpy()] + marks.column("start").to_numpy()
        mask = marks.column("mask").to_numpy()
        for bit in range(SHARED):
            at = first[(mask >> bit) & 1 == 1] + bit
            np.add.at(edge, at, 1)
            np.add.at(edge, at + WINDOW, -1)
    gone = np.cumsum(edge[:-1]) > 0
    removed = np.bincount(words.row[gone], minlength=len(words.count))
    letters, offsets = block.joined(~gone)
    ends = np.cumsum(words.count - removed)
    low, high = offsets[ends - (words.count - removed)], offsets[ends]
    size = np.maximum(high - low - 1, 0)
    kept = _strings(letters, low, size).cast(pa.large_string())
    return pa.table(
        {
            "doc_id": block.docs.column("doc_id"),
            "n_words": pa.array(words.count.astype(np.int64)),
            "n_removed": pa.array(removed.astype(np.int64)),
            "kept": kept.cast(pa.string()),
            "copies": pa.array(block.copies),
        }
    )


def _collapsed(docs: DataFrame) -> DataFrame:
    """Equal rows that hold a large share of the table become one row with their number in ``copies``."""
    docs = docs.withColumns({"h": F.xxhash64("text"), "place": F.xxhash64("doc_id", "text"), "copies": F.lit(1).cast("bigint")})
    hot = durable(hot_keys(docs.groupBy("place").count(), "place").select("place"))  # a bounded list
    if hot.isEmpty():
        return docs
    heavy = docs.join(F.broadcast(hot), "place", "left_semi").groupBy("doc_id", "text", "h", "place").agg(F.count("*").alias("copies"))
    return docs.join(F.broadcast(hot), "place", "left_anti").unionByName(heavy)


def remove_repeats(docs: DataFrame, hot: int = HOT, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs`` (doc_id, text).

    Each word covered by a window that also starts earlier (smaller doc_id, or the same document further to the left) goes;
    windows are judged on the input. ``kept`` holds the other words joined by one space. A null text is empty. Equal rows are
    one document and get one answer each; different texts with one doc_id are taken in the order of a hash of the text. A missing doc_id
    comes first. Further columns are ignored. A text lies in one block whatever its length, with some 60 bytes of memory per byte.
    """
    kind = _kind(docs)
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks, ranges = max(1, -(-size // block_bytes)), max(1, -(-size // range_bytes))
    placed = _collapsed(docs).select("doc_id", "text", "h", "copies", F.pmod("place", F.lit(blocks)).alias("block")).groupBy("block")
    totals = placed.applyInArrow(_ask(ranges), ASKED).groupBy("range").applyInArrow(_answer(hot), TOTALS)
    packed = placed.cogroup(totals.groupBy("block")).applyInArrow(_pack, _packed_schema(kind))
    # a string that its block has sent already needs no bucket, so such rows are spread
    spread = F.when(F.col("words").isNull(), F.xxhash64("block", "ord", "start"))
    ordered = packed.repartition("key", spread).sortWithinPartitions("key", "doc_id", "h", "start")
    marks = ordered.mapInArrow(_repeats, "block bigint, ord int, start int, mask int").where("mask <> 0")
    found = placed.cogroup(marks.groupBy("block")).applyInArrow(_remove, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string, copies bigint")
    return found.select("doc_id", "n_words", "n_removed", "kept", F.explode(F.sequence(F.lit(1), "copies"))).drop("col")
