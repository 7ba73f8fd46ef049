"""Phrase collocations from sorted count streams.

Tasks turn their texts into streams of counted word triples in prefix order: (w1, w2, w3), with an end mark
where a piece ends. The streams are dealt into ranges by a hash of the triple, so that no word or pair lands in one task. A range merges
its streams in lockstep into one exact stream of triples, and sums over equal prefixes give the stream of pairs, which is dealt by
pair and merged likewise, and so on to single words: a very common pair or word reaches the next level as
one entry per range. Triples and pairs that occur often enough are kept as tables. Left, right and extension counts come from merge joins of
these tables in prefix order (on a phrase's first words) and in suffix order (on its last words).

Words are compared as texts everywhere; nothing is identified by a hash.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termfit.llm.spans import bounds, byte_set, fold_bytes, keys
from termfit.llm.words import byte_views, mix
from termfit.session import discard, durable, scratch_path

#: The bytes that end a piece, and those that separate words inside it.
BREAKS = byte_set(*((ord(c), ord(c)) for c in ".,;:!?"), (0x0A, 0x0D))
SPACES = byte_set((0x20, 0x20), (0x09, 0x09))

#: Text bytes that are counted at once (or a single row), and those that one range of a stream stands for.
SLICE_BYTES = 8 << 20
RANGE_BYTES = 16 << 20
LONGEST = 3
LEAST = 10
TOP = 2000
UNKNOWN = "und"

STREAM = "lang string, range int, stream binary"
MERGED = "kind string, lang string, range int, stream binary, words array<string>, f bigint"


class Counts(NamedTuple):
    """Counted word sequences: ascending ``vocabulary``, columns of places in it (from 1; 0 marks an end), their counts."""

    vocabulary: pa.LargeStringArray
    places: list[np.ndarray]
    count: np.ndarray


def _summed(vocabulary: pa.Array, places: list[np.ndarray], count: np.ndarray | None) -> Counts:
    """Equal sequences added up, in prefix order. Ascending stretches are merged as they are."""
    base = len(vocabulary) + 1
    code, wide = places[0], base
    for column in places[1:]:
        wide *= base
        if wide >= 1 << 62:  # number the heads seen instead
            head, code = np.unique(code, return_inverse=True)
            wide = len(head) * base
        code = code * base + column
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.empty(0, np.int64)
    counted = np.ones(len(code), np.int64) if count is None else count[order]
    total = np.add.reduceat(counted, first) if len(first) else np.empty(0, np.int64)
    return Counts(vocabulary, [p[order[first]] for p in places], total)


def _ranked(words: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The distinct words in byte order, and each word's place (from 1)."""
    coded = words.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(1, len(order) + 1)
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy(zero_copy_only=False)]


def _strings(data: np.ndarray, size: np.ndarray) -> pa.LargeStringArray:
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def count_texts(texts: pa.Array) -> Counts:
    """The counted (w1, w2, w3) of all rows; one for each word, with end marks where its piece ends."""
    data, offsets = byte_views(texts)
    data = fold_bytes(data)
    start, end = bounds(data, offsets, ~(BREAKS | SPACES))
    row = np.searchsorted(offsets, start, side="right") - 1
    piece = np.cumsum(BREAKS[data])[start] + row if len(start) else row
    held = ~(BREAKS | SPACES)[data]
    vocabulary, word = _ranked(_strings(data[held], end - start))
    places = [word]
    for by in range(1, LONGEST):
        follows = np.zeros_like(word)
        if len(word) > by:
            follows[:-by] = np.where(piece[by:] == piece[:-by], word[by:], 0)
        places.append(follows)
    return _summed(vocabulary, places, None)


def _pack(counts: Counts) -> bytes:
    """A stream as bytes: its own vocabulary, places byte plane by byte plane (the first as differences), counts."""
    used = np.unique(np.concatenate(counts.places))
    used = used[used > 0]
    words = counts.vocabulary.take(pa.array(used - 1))
    local = [np.where(p > 0, np.searchsorted(used, p) + 1, 0).astype(np.uint32) for p in counts.places]
    local[0] = np.diff(local[0], prepend=np.uint32(0))
    data, offsets = byte_views(words)
    columns = [np.diff(offsets).astype(np.uint32), *local]
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, c.itemsize).T).tobytes() for c in (*columns, counts.count)]
    body = struct.pack("<qqq", len(words), len(counts.count), len(data)) + data.tobytes() + b"".join(planes)
    return struct.pack("<q", len(body)) + pa.compress(body, codec="zstd", asbytes=True)


def _unpack(stream: bytes, length: int) -> Counts:
    body = pa.decompress(stream[8:], decompressed_size=struct.unpack_from("<q", stream)[0], codec="zstd", asbytes=True)
    n_words, n, size = struct.unpack_from("<qqq", body)
    at = 24 + size

    def column(rows: int, kind: type) -> np.ndarray:
        nonlocal at
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(body, np.uint8, rows * width, at).reshape(width, rows)
        at += rows * width
        return np.ascontiguousarray(planes.T).reshape(-1).view(kind)

    words = _strings(np.frombuffer(body, np.uint8, size, 24), column(n_words, np.uint32))
    places = [column(n, np.uint32).astype(np.int64) for _ in range(length)]
    places[0] = np.cumsum(places[0])
    return Counts(words, places, column(n, np.int64))


def _dealt(counts: Counts, lang: str, ranges: int) -> Iterator[tuple[int, bytes]]:
    """The stream cut into ranges by a hash of the whole sequence, each part in prefix order."""
    data, offsets = byte_views(counts.vocabulary)
    word = np.append(np.uint64(0), keys(data, offsets[:-1], offsets[1:], False))
    hashed = np.full(len(counts.count), zlib.crc32(lang.encode()), np.uint64)
    for places in counts.places:
        hashed = mix(hashed + word[places])
    to = (hashed % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(np.diff(to[order], prepend=-1))
    for low, high in zip(cuts, np.append(cuts, len(order))[1:], strict=True):
        part = order[low:high]
        yield int(to[part[0]]), _pack(Counts(counts.vocabulary, [p[part] for p in counts.places], counts.count[part]))


def _by_size(texts: pa.Array) -> Iterator[pa.Array]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    row = 0
    while row < len(texts):
        until = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + SLICE_BYTES, side="right")))
        yield texts.slice(row, until - row)
        row = until


def _count(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                texts = batch.column("text").filter(pc.equal(langs, lang))
                for part in _by_size(texts):
                    rows = list(_dealt(count_texts(part), lang, ranges))
                    yield pa.record_batch(
                        {
                            "lang": pa.array([lang] * len(rows), pa.string()),
                            "range": pa.array([r for r, _ in rows], pa.int32()),
                            "stream": pa.array([s for _, s in rows], pa.binary()),
                        }
                    )

    return run


def _merge(length: int, ranges: int, least: int):
    """One range's streams as one: the sequences counted often enough, and the stream of their heads."""

    def run(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        parts = [_unpack(s, length) for s in table.column("stream").to_pylist()]
        vocabulary, place = _ranked(pa.concat_arrays([p.vocabulary for p in parts]))
        firsts = np.cumsum([0, *(len(p.vocabulary) for p in parts)])
        of = [np.append(0, place[a:b]) for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
        places = [np.concatenate([to[p.places[k]] for to, p in zip(of, parts, strict=True)]) for k in range(length)]
        merged = _summed(vocabulary, places, np.concatenate([p.count for p in parts]))
        kept = np.flatnonzero((merged.places[-1] > 0) & (merged.count >= least))
        texts = pa.ListArray.from_arrays(
            pa.array(np.arange(len(kept) + 1) * length, pa.int32()),
            vocabulary.take(pa.array(np.stack([p[kept] for p in merged.places], 1).reshape(-1) - 1)).cast(pa.string()),
        )
        count = merged.count[kept]
        if length > 1:
            heads = list(_dealt(_summed(vocabulary, merged.places[:-1], merged.count), lang, ranges))
        else:  # all words of the range, as the count of the empty sequence
            heads = []
            texts = pa.concat_arrays([texts, pa.array([[]], pa.list_(pa.string()))])
            count = np.append(count, merged.count.sum())
        n = len(count)
        return pa.table(
            {
                "kind": pa.array(["counts"] * n + ["stream"] * len(heads), pa.string()),
                "lang": pa.array([lang] * (n + len(heads)), pa.string()),
                "range": pa.array([None] * n + [r for r, _ in heads], pa.int32()),
                "stream": pa.array([None] * n + [s for _, s in heads], pa.binary()),
                "words": pa.concat_arrays([texts, pa.nulls(len(heads), texts.type)]),
                "f": pa.concat_arrays([pa.array(count, pa.int64()), pa.nulls(len(heads), pa.int64())]),
            }
        )

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(lang, words, f): the counts of all phrases of up to LONGEST words that occur ``least`` times or more.

    The row with no words holds the number of words of its lang (one row per range: add them up).
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(1, -(-size // range_bytes))
    stream = docs.mapInArrow(_count(ranges), STREAM)
    tables, spent = [], None
    for length in range(LONGEST, 0, -1):
        path = scratch_path(spark, f"phrases-{length}")
        merged = stream.groupBy("lang", "range").applyInArrow(_merge(length, ranges, least), MERGED)
        merged.write.partitionBy("kind").parquet(path)
        if spent:
            discard(spark, spent)
        written = spark.read.schema(MERGED).parquet(path)
        tables.append(written.where("kind = 'counts'").select("lang", "words", "f"))
        stream = written.where("kind = 'stream'").select("lang", "range", "stream")
        spent = f"{path}/kind=stream"
    counts = tables[0]
    for table in tables[1:]:
        counts = counts.unionByName(table)
    return counts


def _by(counts: DataFrame, length: int, *names: str) -> DataFrame:
    """The counted phrases of one length, word by word; ``names`` are those of the words and of the count."""
    words = [F.get("words", F.lit(k)).alias(name) for k, name in enumerate(names[:-1])]
    return counts.where(F.size("words") == length).select("lang", *words, F.col("f").alias(names[-1]))


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)) in decimals of 38 digits."""
    twice = f"cast({a} AS decimal(16,0)) * cast({a} AS decimal(16,0))"
    return F.expr(f"(1000000BD * {twice}) div (cast({left} AS decimal(19,0)) * cast({right} AS decimal(19,0)))")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two or three words per lang of ``docs`` (lang, text).

    A-Z is lower-cased; a null lang is ``und`` and a null text empty. Repeated rows count each. Further columns are ignored. A phrase
    occurs ``least`` times or more (a); its score is that of its worst cut into a first part (l) and a rest (r), the
    shortest first part where cuts are equal; n is the number of words. A phrase inside a longer one with half its count
    or more is left out. A very long text is counted in one piece, with some 60 bytes of memory per byte. Counts up to
    10**15 are exact.
    """
    counts = phrase_counts(docs, least, range_bytes)
    # merge joins: both sides sorted by the words that they share
    merge = lambda left, right, on, how="inner": left.join(right.hint("merge"), ["lang", *on], how)
    single, pairs, triples = _by(counts, 1, "w", "f"), _by(counts, 2, "w1", "w2", "a"), _by(counts, 3, "w1", "w2", "w3", "a")
    pairs = merge(pairs, single.toDF("lang", "w1", "l"), ["w1"])  # prefix order
    pairs = durable(merge(pairs, single.toDF("lang", "w2", "r"), ["w2"]))  # suffix order
    first = pairs.select("lang", "w1", "w2", F.col("a").alias("l2"), F.col("l").alias("l1"))
    last = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"), F.col("r").alias("r2"))
    cut = merge(merge(triples, first, ["w1", "w2"]), last, ["w2", "w3"])
    cut = cut.withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
    lower = F.col("s2") < F.col("s1")
    whole = cut.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(lower, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(lower, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    starts = triples.groupBy("lang", "w1", "w2").agg(F.max("a").alias("starts"))
    ends = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("ends"))
    alone = merge(merge(pairs, starts, ["w1", "w2"], "left"), ends, ["w1", "w2"], "left")
    alone = alone.where(F.coalesce(100 * F.greatest("starts", "ends") < 50 * F.col("a"), F.lit(True)))
    ranked = alone.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score")).unionByName(whole)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # the first of some shares of a lang, then the first of these
    ranked = ranked.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    for by in (["lang", "share"], ["lang"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    n = counts.where(F.size("words") == 0).groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(n.hint("merge"), "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
