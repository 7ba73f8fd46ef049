"""Exact set-similarity self-join on word shingles by partitioning the universe of shingles.

Two sets with Jaccard similarity t differ in at most (|r| + |s|)(1 - t)/(1 + t) shingles.
Sets of one size band hash the universe into m segments, and by the pigeonhole principle
two similar sets agree on some segments exactly, or up to one shingle on the ``wide`` ones,
which are indexed with all their one-deletion neighbours. How many segments are wide, and
how many spare ones there are, is chosen per band by cost. A set leaves out its least
selective segments as far as the spare ones allow (see ``_signatures``). Sets that share
a signature are candidates and are verified on their whole shingle sets.

Equal sets are one node of the join: a class, named by a 64-bit hash of its size and two 64-bit sums over
its shingles. Signatures are dealt out once, packed (see ``_dealt``). The members of a bucket are compared with one of them only. What was
compared with one document and is then in different components is compared by parities, block by block, and in very
large groups only where two members share rare differences from that document (see ``_by_difference``): no bucket is
expanded into its pairs, and no link is lost that would join two components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termfit.llm.exchange import pack_keys, unpack_keys
from termfit.llm.words import lists, mix, salted, shingle_sets, slices
from termfit.plans.joins import lookup
from termfit.session import discard, scratch_path

#: Chance that an unrelated document holds a given shingle too, as the cost model assumes.
SHARED = 0.2
#: Spare segments in proportion to the needed ones.
SPARE = 0.15
#: Members of a group that are compared with one another by their parities in a join.
SMALL = 64
#: Members of a group whose parities are compared block by block; larger groups go by their differences.
LARGE = 1 << 16
#: Members of such a block, and the likely partners that one of them names at first.
BLOCK = 4096
PARTNERS = 16
#: Bits of a signature that are dealt out (more unequal ones meet with fewer bits), and of a place in a slice.
BUCKET_BITS, PLACE_BITS = 48, 16
#: Shingles for which there is one range of buckets.
RANGE = 1 << 20


@dataclass(frozen=True)
class Band:
    """How sets of sizes lo..hi, and the smaller ones similar to them, are cut into segments."""

    lo: int
    hi: int
    segments: int
    wide: int


@dataclass(frozen=True)
class Scheme:
    threshold: Fraction
    bands: tuple[Band, ...]

    @property
    def edges(self) -> np.ndarray:
        return np.array([b.lo for b in self.bands] + [self.bands[-1].hi + 1])


def _differences(total: int | np.ndarray, t: Fraction) -> int | np.ndarray:
    """Most elements in which two sets of ``total`` elements together may differ."""
    return total * (t.denominator - t.numerator) // (t.denominator + t.numerator)


def _band(lo: int, hi: int, docs: int, t: Fraction) -> Band:
    """Cheapest layout for a band that holds ``docs`` sets."""
    allowed = int(_differences(2 * hi, t))
    spare = math.ceil(SPARE * (allowed + 1)) if allowed >= 4 else 0
    need = allowed + 1 + spare

    def cost(wide: int) -> float:
        segments = need - wide
        size = hi / segments
        rows = max(0, allowed + 1 - 2 * wide) + wide * (2 + size)
        return rows + docs * segments * SHARED**size

    wide = min(sorted({(allowed + 1) * i // 16 for i in range(9)}), key=cost)
    return Band(lo, hi, need - wide, wide)


def make_scheme(sizes: dict[int, int], t: Fraction) -> Scheme:
    """``sizes`` counts the sets in each power-of-two size class (the class is the exponent)."""
    largest = 2 ** (max(sizes, default=0) + 1)
    ratio = t**-3
    bands, lo = [], 1
    while lo <= largest:
        following = max(lo + 1, math.ceil(lo * ratio))
        docs = sum(n for e, n in sizes.items() if 2**e < following and 2 ** (e + 1) > lo)
        bands.append(_band(lo, following - 1, docs, t))
        lo = following
    return Scheme(t, tuple(bands))


def _signatures(row: np.ndarray, key: np.ndarray, rows: int, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of the sets given as (row, key), ordered by row.

    A layout with s segments, w of them wide, has weight s + w (a wide one counts twice).
    Two sets that differ in d elements agree on weight s + w - d at least. A set of size n
    differs from any partner by at most H(n), so it may leave out s + w - 1 - H(n) exact
    segments. All sets leave out those with the fewest elements (ties: by signature). Of
    more than that many agreed segments, the last in this order is left out by neither set.

    Part of that weight serves to leave out the signature of an empty wide segment, which unrelated sets share: a set may
    spend ``own`` on it, 2 for an empty segment and 1 for one whose single element is deleted. Two sets lose 2 * own at most.
    """
    t, edges = scheme.threshold, scheme.edges
    n = np.bincount(row, minlength=rows).astype(np.int64)
    home = np.searchsorted(edges, n, side="right") - 1
    found_row, found = [], []
    segments = np.array([b.segments for b in scheme.bands])
    wides = np.array([b.wide for b in scheme.bands])
    his = np.array([b.hi for b in scheme.bands])
    for step in (0, 1):  # the own band, and the next where a larger partner may be
        band = home + step
        used = (n > 0) & (band < len(scheme.bands))
        band = np.where(used, band, 0)
        if step:
            used &= n * t.denominator >= edges[band] * t.numerator
        largest = np.minimum(his[band], n * t.denominator // t.numerator)
        allowed = _differences(n + largest, t)
        used &= allowed > 0  # else only equal sets are similar, and these are merged already
        m = np.where(used, segments[band], 0)
        base = np.cumsum(m) - m
        total = int(m.sum())
        if not total:
            continue
        mine = used[row]
        r, k = row[mine], key[mine]
        cell = base[r] + ((salted(k, 11) >> np.uint64(33)).astype(np.int64) + band[r] * 7919) % m[r]
        element = salted(k, 12)
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, cell, element)
        size = np.bincount(cell, minlength=total)
        owner = np.repeat(np.arange(rows), m)
        index = np.arange(total) - base[owner]
        wide = index < wides[band[owner]]
        place = salted((band[owner].astype(np.uint64) << np.uint64(32)) | index.astype(np.uint64), 13)
        signature = mix(sums ^ place ^ size.astype(np.uint64))
        spare = np.maximum(0, segments[band] + wides[band] - 1 - allowed)
        price = np.where(wide & (size < 2), 2 - size, 0)
        spent = np.cumsum(price)
        spent -= np.where(base > 0, spent[base - 1], 0)[owner]
        own = np.where(wides[band] > 0, spare * 3 // 8, 0)
        bare = wide & (size < 2) & (spent <= own[owner])
        left_out = spare - 2 * own
        exact = np.flatnonzero(~wide)
        order = exact[np.lexsort((signature[exact], size[exact], owner[exact]))]
        per_row = np.bincount(owner[order], minlength=rows)
        rank = np.arange(len(order)) - (np.cumsum(per_row) - per_row)[owner[order]]
        stays = order[rank >= left_out[owner[order]]]
        deleted = wide[cell] & ~bare[cell]
        c = cell[deleted]
        neighbours = mix((sums[c] - element[deleted]) ^ place[c] ^ (size[c] - 1).astype(np.uint64))
        whole = wide & ~(bare & (size == 0))
        found_row += [owner[stays], owner[whole], owner[c]]
        found += [signature[stays], signature[whole], neighbours]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    row, signature = np.concatenate(found_row), np.concatenate(found)
    order = np.argsort(row, kind="stable")
    return row[order], signature[order]


def _class_keys(row: np.ndarray, key: np.ndarray, rows: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(size, two sums, node) of each row's set; equal sets agree in all of them."""
    n = np.bincount(row, minlength=rows).astype(np.int64)
    sums = []
    for salt in (1, 2):
        total = np.zeros(rows, np.uint64)
        np.add.at(total, row, salted(key, salt))
        sums.append(total)
    node = mix(mix(sums[0] + np.uint64(0x632BE59BD9B4E019)) + sums[1]) ^ salted(n.astype(np.uint64), 17)
    return n, sums, node.view(np.int64)


def _sketches(row: np.ndarray, key: np.ndarray, rows: int) -> pa.Array:
    """A set's parities: bit i tells whether an odd number of its elements hash to i. The number of bits is the power of two from its size on, 64 at least.

    Two sets of one length differ in as many elements as their parities differ in bits, or more.
    """
    n = np.bincount(row, minlength=rows)
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    base = np.cumsum(bits) - bits
    at = base[row] + (salted(key, 21) >> np.uint64(20)).astype(np.int64) % bits[row]
    odd = (np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8)
    words = np.packbits(odd, bitorder="little").view("<i8").astype(np.int64)
    return lists(np.repeat(np.arange(rows), bits // 64), words, rows)


def _within(t: Fraction) -> Column:
    """False for pairs (n_x, sketch_x, n_y, sketch_y) that are not similar by their sizes or parities."""
    # the longer parities are folded to the length of the others
    folded = "zip_with(slice({0}, 1, size({0}) DIV 2), slice({0}, size({0}) DIV 2 + 1, size({0}) DIV 2), (p, q) -> p ^ q)"
    x, y = (f"CASE WHEN size({a}) > size({b}) THEN {folded.format(a)} ELSE {a} END" for a, b in (("sketch_x", "sketch_y"), ("sketch_y", "sketch_x")))
    apart = F.expr(f"aggregate(zip_with({x}, {y}, (p, q) -> bit_count(p ^ q)), 0, (s, v) -> s + coalesce(v, 0))")
    sizes = F.least("n_x", "n_y") * t.denominator >= F.greatest("n_x", "n_y") * t.numerator
    return sizes & (apart * (t.denominator + t.numerator) <= (F.col("n_x") + F.col("n_y")) * (t.denominator - t.numerator))


def _likely(pairs: DataFrame, sketches: DataFrame, t: Fraction) -> DataFrame:
    """The pairs (a, b) that ``_within`` does not rule out."""
    x, y = (sketches.select(F.col("node").alias(end), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")) for end, side in (("a", "x"), ("b", "y")))
    return pairs.join(y, "b").join(x, "a").where(_within(t)).select("a", "b")


def _summaries(shingle_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                row, key = shingle_sets(batch.column("text"), shingle_size)
                n, sums, node = _class_keys(row, key, batch.num_rows)
                columns = [batch.column("doc_id"), *map(pa.array, (n, sums[0].view(np.int64), sums[1].view(np.int64), node)), _sketches(row, key, batch.num_rows)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "a", "b", "node", "sketch"])

    return run


def _places(block: np.ndarray | int, at: np.ndarray) -> np.ndarray:
    """The 64-bit names of the different sets of slices."""
    return mix(np.asarray(block, np.int64).view(np.uint64) + salted(at.astype(np.uint64), 31)).view(np.int64)


def _dealt(shingle_size: int, scheme: Scheme, ranges: int):
    """Slices as rows (range, block, packed): the signatures of the slice's different sets, and under a negative range their nodes.

    A signature takes 64 bits with the place of its set in the slice. They are packed as ascending numbers, some 6 bytes each; the block
    is a hash of the nodes, so that it names the same sets whichever task computes them.
    """
    cuts = np.array([-(-(i << BUCKET_BITS) // ranges) << PLACE_BITS for i in range(ranges)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole):
                for low in range(0, part.num_rows, 1 << PLACE_BITS):
                    batch = part.slice(low, 1 << PLACE_BITS)
                    row, key = shingle_sets(batch.column("text"), shingle_size)
                    _, _, node = _class_keys(row, key, batch.num_rows)
                    first = np.sort(np.unique(node, return_index=True)[1])
                    number = np.full(batch.num_rows, -1)
                    number[first] = np.arange(len(first))
                    row, key = number[row], key[number[row] >= 0]
                    row, signature = _signatures(row[row >= 0], key, len(first), scheme)
                    entries = np.unique((signature >> np.uint64(64 - BUCKET_BITS)) << np.uint64(PLACE_BITS) | row.astype(np.uint64))
                    nodes = node[first]
                    block = int(mix(np.uint64(len(nodes)) + salted(nodes.view(np.uint64) + salted(np.arange(len(nodes), dtype=np.uint64), 32), 33).sum(keepdims=True)).view(np.int64)[0])
                    at = np.append(np.searchsorted(entries, cuts), len(entries))
                    held = np.flatnonzero(at[:-1] < at[1:])
                    packed = [pack_keys(entries[at[i] : at[i + 1]]) for i in held]
                    columns = [pa.array([*held.tolist(), -1 - block % ranges], pa.int32()), pa.array([block] * (len(held) + 1), pa.int64()), pa.array([*packed, nodes.tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["range", "block", "packed"])

    return run


def _met(dealt: pa.Table) -> pa.Table:
    """Of a range of buckets (first, place): a bucket's members, each beside the first of them. Of nodes (null, place, node)."""
    blocks = dealt.column("block").to_numpy()
    order = np.argsort(blocks, kind="stable")
    blocks, packed = blocks[order], (dealt.column("packed")[int(i)].as_py() for i in order)
    if dealt.column("range")[0].as_py() < 0:
        nodes = [np.frombuffer(p, np.int64) for p in packed]
        places = [_places(block, np.arange(len(n))) for block, n in zip(blocks, nodes, strict=True)]
        place = np.concatenate(places)
        return pa.table({"first": pa.nulls(len(place), pa.int64()), "place": place, "node": np.concatenate(nodes)})
    entries = [unpack_keys(p) for p in packed]
    rank = np.repeat(np.arange(len(entries)), [len(e) for e in entries])
    entries = np.concatenate(entries)
    bucket = entries >> np.uint64(PLACE_BITS)
    who = entries.view(np.int64)
    who &= (1 << PLACE_BITS) - 1
    rank <<= PLACE_BITS
    who |= rank
    del rank
    order = np.argsort(bucket, kind="stable")
    bucket, who = bucket[order], who[order]
    del entries, order
    new = np.ones(len(bucket), bool)
    new[1:] = bucket[1:] != bucket[:-1]
    first, member = who[new][np.cumsum(new)[~new] - 1], who[~new]
    order = np.lexsort((member, first))
    first, member = first[order], member[order]
    other = np.ones(len(first), bool)
    other[1:] = (first[1:] != first[:-1]) | (member[1:] != member[:-1])
    ends = [_places(blocks[w >> PLACE_BITS], w & ((1 << PLACE_BITS) - 1)) for w in (first[other], member[other])]
    return pa.table({"first": ends[0], "place": ends[1], "node": pa.nulls(len(ends[0]), pa.int64())})


def _sent(parts: int):
    """What ``_met`` finds in a range, packed into rows (part, firsts, places, nodes): a place is always sent to the same part."""

    def run(dealt: pa.Table) -> pa.Table:
        met = _met(dealt)
        place = met.column("place").to_numpy()
        part = (salted(place.view(np.uint64), 34) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        held, at = np.unique(part[order], return_index=True)
        columns = [None if met.column(c).null_count else met.column(c).to_numpy()[order] for c in ("first", "place", "node")]
        cuts = list(zip(at, [*at[1:], len(part)], strict=True))
        packed = [pa.array([None if c is None else c[lo:hi].tobytes() for lo, hi in cuts], pa.binary()) for c in columns]
        return pa.Table.from_arrays([pa.array(held), *packed], ["part", "firsts", "places", "nodes"])

    return run


def _named(sent: pa.Table) -> pa.Table:
    """Of a part: (null, place, node), and (first, place, node) for what met, once each however many ranges found it."""
    firsts, places, nodes = (sent.column(c).to_pylist() for c in ("firsts", "places", "nodes"))
    number = lambda chunks: np.frombuffer(b"".join(chunks), np.int64)
    own = np.unique(np.stack([number(p for p, n in zip(places, nodes, strict=True) if n is not None), number(n for n in nodes if n is not None)]), axis=1)
    met = np.stack([number(p for p, f in zip(places, firsts, strict=True) if f is not None), number(f for f in firsts if f is not None)])
    met = met[:, np.lexsort(met[::-1])]
    new = np.ones(met.shape[1], bool)
    new[1:] = (met[:, 1:] != met[:, :-1]).any(axis=0)
    place, first = met[:, new]
    node = own[1][np.searchsorted(own[0], place)] if len(place) else place
    found = [pa.chunked_array([pa.nulls(own.shape[1], pa.int64()), pa.array(first)])]
    found += [pa.array(np.concatenate(x)) for x in ((own[0], place), (own[1], node))]
    return pa.table(dict(zip(("first", "place", "node"), found, strict=True)))


def _stars(docs: DataFrame, shingle_size: int, scheme: Scheme, shingles: int, stored: _Scratch) -> DataFrame:
    """(first, node): the members of each bucket beside one of them. ``shingles`` is the number in all different sets."""
    ranges = max(1, -(-shingles // RANGE))
    dealt = docs.where("doc_id IS NOT NULL").mapInArrow(_dealt(shingle_size, scheme, ranges), "range int, block bigint, packed binary")
    sent = dealt.groupBy("range").applyInArrow(_sent(ranges), "part int, firsts binary, places binary, nodes binary")
    met = stored(sent.groupBy("part").applyInArrow(_named, "first bigint, place bigint, node bigint"), "met")
    places = met.where("first IS NULL").groupBy("place").agg(F.min("node").alias("node"), F.max("node").alias("other"))
    places = stored(places, "places")
    if places.where("node <> other").limit(1).count():
        raise RuntimeError("two different places have the same 64-bit name")
    firsts = places.select(F.col("place").alias("first"), F.col("node").alias("first_node"))
    found = met.where("first IS NOT NULL").select("first", "node").join(firsts, "first")
    stars = stored(found.where("first_node <> node").select(F.col("first_node").alias("first"), "node").distinct(), "stars")
    stored.drop(met, places)
    return stars


def _sets(shingle_size: int):
    """The sets of the rows whose text has the set of the wanted node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                row, key = shingle_sets(batch.column("text"), shingle_size)
                _, _, node = _class_keys(row, key, batch.num_rows)
                column = lists(row, key.view(np.int64), batch.num_rows)
                same = pa.array(node == batch.column("node").to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column("node"), column], ["node", "shingles"]).filter(same)

    return run


def _noded(shingle_size: int):
    """The rows with their node in front."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                _, _, node = _class_keys(*shingle_sets(batch.column("text"), shingle_size), batch.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(node), *batch.columns], ["_node", *batch.schema.names])

    return run


class _Scratch:
    """Tables written to the shared folder, to go on from there; all but those that the result reads are deleted."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.paths.pop(id(table), None)
            if path:
                discard(self.spark, path)


def components(links: DataFrame, stored: _Scratch) -> DataFrame:
    """(id, component) for the ends of ``links`` (a, b): the smallest id that is reachable.

    Every round takes the smallest label among the neighbours and then the label's own label,
    so that the length of a chain is at least halved.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
    kept = stored(labels.select("id", F.least("id", "m").alias("component")), "labels")
    labels = kept
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id"))
        moved = labels.join(near.agg(F.min("component").alias("m")), "id").select(
            "id", "component", F.least("component", "m").alias("lower")
        )
        up = labels.select(F.col("id").alias("lower"), F.col("component").alias("top"))
        moved = moved.join(up, "lower", "left").select("id", "component", F.coalesce("top", "lower").alias("next"))
        moved = stored(moved, "labels")
        changed = moved.where("next <> component").limit(1).count()
        stored.drop(kept)
        kept, labels = moved, moved.select("id", F.col("next").alias("component"))
        if not changed:
            stored.drop(both)
            return labels


def _merged(labels: DataFrame, links: DataFrame, stored: _Scratch) -> DataFrame:
    """``labels`` of ``components`` after further stored links (a, b): only those between components are followed."""
    if not links.limit(1).count():
        return labels
    ends = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    labels = stored(labels.join(ends, "id", "full").select("id", F.coalesce("component", "id").alias("component")), "labels")
    x, y = (labels.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}")) for end in "ab")
    between = links.select("a", "b").join(x, "a").join(y, "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    tops = components(between, stored).select(F.col("id").alias("component"), F.col("component").alias("top"))
    merged = stored(labels.join(tops, "component", "left").select("id", F.coalesce("top", "component").alias("component")), "labels")
    stored.drop(labels)
    return merged


def _grouped(docs: DataFrame, shingle_size: int, threshold: Fraction) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summaries, classes, spanning pairs); classes are (node, representative, component, component_id).

    Components are named by a node; component_id is the smallest doc_id, which several may share where ids repeat.
    """
    stored = _Scratch(docs.sparkSession)
    summaries = stored(
        docs.mapInArrow(_summaries(shingle_size), "doc_id bigint, n_shingles bigint, a bigint, b bigint, node bigint, sketch array<bigint>"), "summaries"
    )
    filled = summaries.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(filled.groupBy("node", "n_shingles", "a", "b").agg(F.min("doc_id").alias("representative")), "classes")
    if classes.select("node").distinct().count() < classes.count():
        raise RuntimeError("two different sets have the same 64-bit name")
    by_size = classes.groupBy(F.floor(F.log2("n_shingles")).cast("int").alias("e"))  # size classes
    counted = by_size.agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("shingles")).collect()
    scheme = make_scheme({r["e"]: r["sets"] for r in counted}, threshold)
    stars = _stars(docs, shingle_size, scheme, sum(r["shingles"] for r in counted), stored)

    ids = stars.select("node").union(stars.select("first")).distinct()
    sketches = filled.select("node", "n_shingles", "sketch").join(ids, "node", "left_semi").dropDuplicates(["node"])
    sketches = stored(sketches, "sketches")
    likely = stored(_likely(stars.select(F.col("first").alias("a"), F.col("node").alias("b")), sketches, threshold), "likely")
    links = _verified(docs, classes, likely, shingle_size, threshold, stored)
    stored.drop(likely)
    labels = components(links, stored)
    # A group is what was compared with one set. It is active while it holds different components.
    group = _labelled(stars, labels)
    mixed = group.groupBy("first").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members"))
    active = stored(group.join(mixed.where("lo <> hi").select("first", "members"), "first"), "active")
    stored.drop(stars)
    if active.limit(1).count():
        pairs = stored(_inside(active.where(F.col("members") <= SMALL), sketches, threshold), "pairs")
        large = active.where(F.col("members") > max(SMALL, LARGE)).drop("members")
        if large.limit(1).count():
            sets = _wanted_sets(docs, classes, large.select("node").union(large.select("first")).distinct(), shingle_size, stored)
            pairs = pairs.union(stored(_likely(_by_difference(large, sets, threshold, stored), sketches, threshold), "pairs"))
            stored.drop(sets)
        between = active.where((F.col("members") > SMALL) & (F.col("members") <= LARGE)).withColumn("known", F.col("component"))
        before, most, asked = 0, PARTNERS, None
        while True:
            partners = stored(_partners(between, sketches, threshold, before, most), "partners")
            met = partners.select("a", "b")
            new = stored(met.distinct().join(asked, ["a", "b"], "left_anti") if asked else met.union(pairs).distinct(), "pairs")
            asked = asked.union(new) if asked else new
            found = _verified(docs, classes, new, shingle_size, threshold, stored)
            links = links.union(found)
            labels = _merged(labels, found, stored)
            more = partners.where("more").limit(1).count()
            stored.drop(partners)
            if not more:
                break
            # All name further partners, of those that are in other components still.
            between, before, most = _labelled(between, labels), most, 8 * most
    stored.drop(active, sketches)

    named = classes.join(labels.withColumnRenamed("id", "node"), "node", "left")
    named = named.select("node", "representative", F.coalesce("component", "node").alias("component"))
    lowest = named.groupBy("component").agg(F.min("representative").alias("component_id"))
    named = stored(named.join(lowest, "component").select("node", "representative", "component", "component_id"), "named")
    ends = [named.select(F.col("node").alias(end), F.col("representative").alias(f"doc_{end}")) for end in ("a", "b")]
    spanning = links.join(ends[0], "a").join(ends[1], "b").select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"), "shared", "n_a", "n_b")
    stored.drop(classes)
    return summaries, named, spanning


def _labelled(group: DataFrame, labels: DataFrame) -> DataFrame:
    """Groups (first, node, ...) with the components that ``labels`` gives; a node without links is its own."""
    named = group.select(*(c for c in group.columns if c != "component")).join(labels.withColumnRenamed("id", "node"), "node", "left")
    return named.withColumn("component", F.coalesce("component", "node"))


def _wanted_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, shingle_size: int, stored: _Scratch) -> DataFrame:
    """(node, shingles) of the nodes given, stored. Texts move only where the list of the wanted ones is too large to go to them."""
    wanted = stored(classes.join(ids, "node").select("node", F.col("representative").alias("doc_id")), "wanted")
    found = lookup(docs, wanted, "doc_id", by=["text"]).select("node", "text")
    sets = stored(found.mapInArrow(_sets(shingle_size), "node bigint, shingles array<bigint>").dropDuplicates(["node"]), "sets")
    stored.drop(wanted)
    return sets


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle_size: int, threshold: Fraction, stored: _Scratch) -> DataFrame:
    """The stored pairs that are similar. Only their sets are read."""
    ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _wanted_sets(docs, classes, ids, shingle_size, stored)
    found = stored(verify(pairs, sets, threshold), "found")
    stored.drop(sets)
    return found


def _inside(active: DataFrame, sketches: DataFrame, t: Fraction) -> DataFrame:
    """Pairs (a, b) of different components inside small groups (first, node, component) that ``_within`` does not rule out."""
    held = active.join(sketches, "node").select("first", "node", "component", "n_shingles", "sketch")
    x, y = (held.select("first", *(F.col(c).alias(f"{to}_{side}") for c, to in zip(held.columns[1:], ("node", "component", "n", "sketch"), strict=True))) for side in "xy")
    met = x.join(y, "first").where("node_x < node_y AND component_x <> component_y").where(_within(t))
    return met.select(F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct()


def _close(t: Fraction, before: int, most: int):
    """For the members (part, node, known, component, n_shingles, sketch) of two parts: pairs (a, b) of ``_within`` and different components.

    Of its partners by the components ``known`` at first, in a fixed order, a member names those from ``before`` up to ``most``, so that
    no round repeats another; ``more`` tells whether there are others behind them.
    """
    less, whole = t.denominator - t.numerator, t.denominator + t.numerator

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("n_shingles", "ascending"), ("node", "ascending")])
        two = group.column("low")[0].as_py() != group.column("high")[0].as_py()
        n, node, known, component, part = (group.column(c).to_numpy() for c in ("n_shingles", "node", "known", "component", "part"))
        sketch = group.column("sketch").combine_chunks()
        size = pc.list_value_length(sketch).to_numpy()  # ascends with n
        values, ends = sketch.flatten().to_numpy().view(np.uint64), np.cumsum(size)
        last = np.searchsorted(n * t.numerator, n * t.denominator, side="right")
        lows = np.flatnonzero(np.diff(size, prepend=0))
        levels = [(lo, hi, values[ends[lo] - size[lo] : ends[hi - 1]].reshape(hi - lo, -1)) for lo, hi in zip(lows, [*lows[1:], len(n)], strict=True)]
        a, b, more = [], [], []
        for k, (start, stop, mine) in enumerate(levels):
            others = []
            for lo, hi, bits in levels[k:]:
                while bits.shape[1] > mine.shape[1]:  # the longer parities are folded
                    bits = bits[:, : bits.shape[1] // 2] ^ bits[:, bits.shape[1] // 2 :]
                others.append((lo, hi, bits))
                if last[stop - 1] <= hi:
                    break
            for i in range(start, stop):
                found = []
                for lo, hi, bits in others:
                    low, high = max(lo, i + 1), min(hi, last[i])
                    if low < high:
                        apart = np.bitwise_count(bits[low - lo : high - lo] ^ mine[i - start]).sum(axis=1, dtype=np.int64)
                        fits = (apart * whole <= (n[i] + n[low:high]) * less) & (known[low:high] != known[i])
                        found.append(low + np.flatnonzero(fits & (part[low:high] != part[i]) if two else fits))
                found = np.concatenate(found)[before:] if found else np.empty(0, np.int64)
                apart = component[found] != component[i]
                named = found[: most - before][apart[: most - before]]
                further = found[most - before :][apart[most - before :]]
                named = named if len(named) else further[:1]  # else nobody learns of the further ones
                a.append(np.full(len(named), node[i]))
                b.append(node[named])
                more.append(np.full(len(named), len(further) > 0))
        x, y = np.concatenate(a), np.concatenate(b)
        return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y), "more": np.concatenate(more)})

    return run


def _partners(active: DataFrame, sketches: DataFrame, t: Fraction, before: int, most: int) -> DataFrame:
    """(a, b, more) of ``_close`` for groups (first, node, known, component, members), two parts of BLOCK members at a time."""
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    held = active.join(sketches, "node").withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
    pairs = held.withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1)))
    pairs = pairs.select("first", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"), "part", "node", "known", "component", "n_shingles", "sketch")
    return pairs.groupBy("first", "low", "high").applyInArrow(_close(t, before, most), "a bigint, b bigint, more boolean")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def jaccard_components(
    docs: DataFrame, shingle_size: int = 5, threshold: Fraction = Fraction(4, 5)
) -> tuple[DataFrame, DataFrame]:
    """Link documents whose sets of word shingles have a Jaccard similarity of ``threshold`` or more.

    Returns (members, spanning). members is (doc_id, n_shingles, component_id), one row per row
    of ``docs`` (doc_id BIGINT, text); component_id is the smallest doc_id that can be reached by
    links. spanning is (a, b, shared, n_a, n_b): verified links between different sets, named by their smallest doc_id, that
    are enough to join these components; it does not hold every link.

    A text without words, empty or null has an empty set and links with nothing. Rows without
    doc_id get component NULL and link with nothing. Rows that repeat a doc_id count as one
    document if their sets are equal; otherwise each row gets the component of its own set. Further columns are ignored.
    Sets are named by 64-bit hashes; two with one name end the job with an error (odds of N * N / 2**65 for N different sets).
    """
    summaries, named, spanning = _grouped(_plain(docs), shingle_size, threshold)
    filled = summaries.where("n_shingles > 0 AND doc_id IS NOT NULL")
    linked = lookup(filled, named.select("node", "component_id"), "node", by=["doc_id"])
    alone = summaries.where("n_shingles = 0 OR doc_id IS NULL").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return linked.select(columns).union(alone.select(columns)), spanning


def first_of_groups(docs: DataFrame, shingle_size: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """The rows of ``docs`` (doc_id BIGINT, text, ...) that stay when one row of each component of ``jaccard_components`` does.

    That is the row with the component's smallest doc_id; of rows that share it, the one with the smallest values. Rows that link with
    nothing because they have no doc_id or no words all stay.
    """
    _, named, _ = _grouped(_plain(docs), shingle_size, threshold)
    # of several sets with the smallest doc_id, one stands for the component
    heads = named.groupBy("component").agg(F.min(F.struct("representative", "node")).alias("head"))
    heads = heads.select(F.col("head.representative").alias("doc_id"), F.col("head.node").alias("_node"))
    schema = ", ".join(["_node bigint", *(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)])
    linkable = F.col("doc_id").isNotNull() & F.coalesce(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    rows = docs.where(linkable).mapInArrow(_noded(shingle_size), schema)
    kept = rows.join(heads, ["doc_id", "_node"]).groupBy("doc_id", "_node").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return kept.select("row.*").unionByName(docs.where(~linkable))


def _by_difference(active: DataFrame, sets: DataFrame, t: Fraction, stored: _Scratch) -> DataFrame:
    """Pairs (a, b) to compare inside groups (first, node, component) that hold several components.

    Let D(x) be the difference of x and the group's first document. Two members differ
    in the symmetric difference of D(x) and D(y). If |D(x)| + |D(y)| <= H they are similar for certain, so it is
    enough to compare all with the member for which |D| - (|x| share of H) is least. Else similar ones share
    o = (|D(x)| + |D(y)| - H) / 2 elements of D or more, and the prefix principle holds: with D ordered from
    the rarest element on, the shorter of the two holds a shared element among its first H/2 + 1 (``index``), the
    longer among its first H + 1, with o - 1 elements behind the first shared one in both.
    """
    left = sets.select("node", F.col("shingles").alias("mine"))
    right = sets.select(F.col("node").alias("first"), F.col("shingles").alias("other"))
    n = F.size("mine").cast("bigint")
    less, more = t.denominator - t.numerator, t.denominator + t.numerator
    allowed = F.floor((n + F.floor(n * t.denominator / t.numerator)) * less / more).cast("int")
    differing = F.concat(F.array_except("mine", "other"), F.array_except("other", "mine"))
    apart = active.join(left, "node").join(right, "first").select(
        "first", "node", "component", allowed.alias("allowed"), differing.alias("d"),
        (F.size(differing) * more - n * less).alias("far"),
    )
    apart = stored(apart, "differences")
    # The near ones.
    best = apart.groupBy("first").agg(F.min(F.struct("far", "node", "component")).alias("best"))
    near = apart.where("size(d) <= allowed").join(best, "first").where("component <> best.component")
    near = near.select(F.least("node", "best.node").alias("a"), F.greatest("node", "best.node").alias("b"))
    # The ones that share an element.
    rows = apart.select("first", "node", "component", "allowed", F.explode("d").alias("element"))
    counts = rows.groupBy("first", "element").count()
    ranked = rows.join(counts.where("count > 1"), ["first", "element"], "left").select(
        "first", "node", "component", "allowed", F.struct(F.coalesce("count", F.lit(1)).alias("n"), "element").alias("e")
    )
    # D is at most as long as the two sets, so one document's part fits a task.
    ranked = ranked.groupBy("first", "node", "component", "allowed").agg(F.sort_array(F.collect_list("e")).alias("d"))
    prefix = F.slice("d", F.lit(1), F.col("allowed") + 1)
    placed = ranked.select(
        "first", "node", "component", "allowed", F.size("d").alias("size"), F.posexplode(prefix).alias("at", "e")
    ).where("e.n > 1")
    placed = placed.withColumn("bucket", F.xxhash64("first", "e.element")).drop("first", "e")
    placed = stored(placed, "placed")
    buckets = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    buckets = stored(buckets.where("lo <> hi").select("bucket"), "mixed")
    x = placed.where("2 * at <= allowed").join(buckets, "bucket")
    y = placed.join(buckets, "bucket").select("bucket", *(F.col(c).alias(f"{c}_y") for c in placed.columns if c != "bucket"))
    shared = F.col("size") + F.col("size_y") - F.least("allowed", "allowed_y")
    behind = F.least(F.col("size") - F.col("at"), F.col("size_y") - F.col("at_y"))
    met = x.join(y, "bucket").where((F.col("component") != F.col("component_y")) & (2 * behind >= shared))
    met = met.select(F.least("node", "node_y").alias("a"), F.greatest("node", "node_y").alias("b"))
    return near.union(met).distinct()


def verify(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) whose whole sets (node, shingles) reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    shared = F.size(F.array_intersect("left", "right")).cast("bigint")
    both = pairs.join(right, "b").join(left, "a").select(
        "a", "b", shared.alias("shared"), F.size("left").cast("bigint").alias("n_a"), F.size("right").cast("bigint").alias("n_b")
    )
    reached = F.col("shared") * threshold.denominator >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * threshold.numerator
    return both.where(reached)
