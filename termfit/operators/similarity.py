"""Cosine similarity of score tables.

Both sides are stacked in one table and summed per term, which gives the numerator and
both norms from a single aggregation: no join on the term, so a hot term costs one
partial sum per task. Terms repeated on a side multiply out as they would in a join.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfit.plans.joins import fits_broadcast, hot_keys, measured_bytes, salted_join
from termfit.session import durable, stored

# The functions below run in Python workers, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _cosine(stacked: DataFrame, keys: list[str]) -> DataFrame:
    zero = F.lit(0.0)
    per_term = stacked.groupBy(*keys, "term").agg(
        F.coalesce(F.sum("a"), zero).alias("a"),
        F.coalesce(F.sum("b"), zero).alias("b"),
        F.coalesce(F.sum(F.col("a") * F.col("a")), zero).alias("aa"),
        F.coalesce(F.sum(F.col("b") * F.col("b")), zero).alias("bb"),
    )
    sums = per_term.groupBy(*keys).agg(
        F.sum(F.col("a") * F.col("b")).alias("ab"), F.sum("aa").alias("aa"), F.sum("bb").alias("bb")
    )
    norms = F.sqrt("aa") * F.sqrt("bb")
    return sums.select(*keys, F.try_divide("ab", norms).alias("cosine"))


def cosine_similarity(a: DataFrame, b: DataFrame, value: str | None = None) -> DataFrame:
    """(cosine): one row for two (term, value) tables.

    0 when they share no term, NULL when a side is empty or all zero.
    """
    nothing = F.lit(None).cast("double")
    value_a, value_b = (F.col(value or table.columns[-1]).cast("double") for table in (a, b))
    stacked = a.select("term", value_a.alias("a"), nothing.alias("b")).unionByName(
        b.select("term", nothing.alias("a"), value_b.alias("b"))
    )
    return _cosine(stacked, [])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The scores of a batch as one row per document; a batch bounds how long a row can be."""
    for batch in batches:
        coded = batch.column("_doc").dictionary_encode()
        order = np.argsort(coded.indices.to_numpy(), kind="stable")
        sizes = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, batch.column(c).take(pa.array(order))) for c in ("term", "_value")]
        yield pa.record_batch({"_doc": coded.dictionary, "_terms": lists[0], "_values": lists[1]})


def packed_vectors(scores: DataFrame) -> DataFrame:
    """(_doc, _terms, _values) from (_doc, term, _value): a document is one row per task and batch that holds it.

    No shuffle is needed for that, and a document of any size becomes rows of bounded size.
    """
    kind, term = (scores.schema[c].dataType.simpleString() for c in ("_doc", "term"))
    return scores.where("_doc IS NOT NULL").mapInArrow(_pack, f"_doc {kind}, _terms array<{term}>, _values array<double>")


def pairwise_cosine(
    scores: DataFrame,
    pairs: DataFrame,
    doc: str = "doc_id",
    value: str = "tfidf",
    left: str = "doc_a",
    right: str = "doc_b",
    small_pairs: bool | None = None,
) -> DataFrame:
    """(left, right, cosine) for every distinct pair of documents of a scored corpus.

    The scores are read once and packed: a document travels as arrays, and a pair asks for its two documents
    as two rows. Both meet in one exchange by pair, and terms are only unpacked behind it. The pair list
    is stored and measured, and broadcast if it fits (``small_pairs=False`` forbids that). Otherwise the packed scores are
    stored, and documents that occur in many pairs, or hold many scores, are split over tasks.
    """
    pairs = durable(pairs.select(left, right).distinct())
    # two requests per pair, each a little wider than the pair
    small = small_pairs is not False and fits_broadcast(4 * measured_bytes(pairs))
    requests = pairs.select(
        left,
        right,
        F.inline(
            F.array(
                F.struct(F.col(left).alias("_doc"), F.lit("a").alias("_side")),
                F.struct(F.col(right).alias("_doc"), F.lit("b").alias("_side")),
            )
        ),
    )
    kind = "bigint" if dict(scores.dtypes)["term"] == "bigint" else "string"
    scores = scores.select(F.col(doc).alias("_doc"), F.col("term").cast(kind).alias("term"), F.col(value).cast("double").alias("_value"))
    if small:
        # only what some pair asks for is packed
        asked = scores.join(F.broadcast(requests.select("_doc")), "_doc", "left_semi")
        matched = packed_vectors(asked).join(F.broadcast(requests), "_doc")
    else:
        packed = stored(packed_vectors(scores), "packed")  # counted and joined
        matched = salted_join(
            requests,
            packed,
            "_doc",
            hot_left=durable(hot_keys(requests.groupBy("_doc").count(), "_doc")),
            left_by=[left, right, "_side"],
            hot_right=durable(hot_keys(packed.groupBy("_doc").agg(F.sum(F.size("_terms")).alias("count")), "_doc")),
            right_by=["_terms"],
        )
    nothing = F.lit(None)
    unscored = pairs.select(
        left,
        right,
        nothing.cast("string").alias("_side"),
        F.array(nothing.cast(kind)).alias("_terms"),
        F.array(nothing.cast("double")).alias("_values"),
    )
    # dealt by pair while packed; both aggregations fit that
    dealt = matched.select(left, right, "_side", "_terms", "_values").unionByName(unscored).repartition(left, right)
    scored = dealt.select(left, right, "_side", F.inline(F.arrays_zip("_terms", "_values")).alias("term", "_value"))
    sides = [F.when(F.col("_side") == side, F.col("_value")).alias(side) for side in ("a", "b")]
    return _cosine(scored.select(left, right, "term", *sides), [left, right])
