"""Scoring a whole corpus and comparing its documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfit.operators.pieces import add_up_in_place
from termfit.operators.similarity import pairwise_cosine
from termfit.operators.text import document_term_frequency, tfidf_value
from termfit.plans.joins import fits_broadcast, lookup_frequent, measured_bytes
from termfit.session import stored

#: Parquet settings for ``counts``: a term leaves out the letters it begins with like the one before it.
SORTED_TERMS = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#counts.list.element.term": "false"}


def score_corpus(docs: DataFrame, text: str = "text", doc: str = "doc_id", numbered: bool = False) -> DataFrame:
    """(doc, term, tfidf) for a table with one whole document per row.

    The texts are read once: their terms are counted inside the row and stored, and the vocabulary is computed from that. It is
    broadcast as far as it fits, the most frequent terms first, so that their scores stay with the document; only the rows
    of the other terms are shuffled. With ``numbered``, ``term`` is a BIGINT that stands for the term inside this result, which is all that
    comparing documents needs.
    """
    n = docs.agg(F.count(F.lit(1))).scalar().cast("double")
    tf = stored(document_term_frequency(docs, text, [doc]), "counts")
    return _scored(tf, n, doc, numbered)


def _scored(tf: DataFrame, n: Column, doc: str, numbered: bool = False) -> DataFrame:
    """(doc, term, tfidf) from stored (doc, term, tf) of ``n`` documents."""
    number = [F.monotonically_increasing_id().alias("_number")] if numbered else []
    idf = stored(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", "df", F.log(n / F.col("df")).alias("idf"), *number), "vocabulary")
    scored = lookup_frequent(tf, idf, "term", "df", by=[doc])
    return scored.select(doc, F.col("_number").alias("term") if numbered else "term", tfidf_value())


def score_parts(parts: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc, term, tfidf) for a table in which a document is any number of rows, as ``read_corpus_parts`` gives it.

    Terms are counted inside each row, so no row has to hold a whole document. Rows are cut at white space, which no term crosses. The parts
    are read once: the counts of a document's neighbouring parts are added up where they are read and stored as one row, and only
    documents that still have several rows (parts in other tasks, very many terms) are exchanged. A document without terms is a row
    without counts.
    """
    pieces = stored(add_up_in_place(document_term_frequency(parts, text, [doc], packed=True)), "counts", **SORTED_TERMS)
    rows = pieces.groupBy(doc).agg(F.count(F.lit(1)).alias("_rows"))
    n, several = rows.agg(F.count(F.lit(1)), F.count_if(F.col("_rows") > 1)).first()
    tf = pieces
    if several:
        divided = stored(rows.where("_rows > 1").select(F.col(doc).alias("_divided")), "divided")
        if fits_broadcast(measured_bytes(divided)):
            divided = F.broadcast(divided)
        on = F.col(doc).eqNullSafe(F.col("_divided"))
        whole = pieces.join(divided, on, "left_semi").select(doc, F.inline("counts")).groupBy(doc, "term").agg(F.sum("tf").alias("tf"))
        merged = stored(whole, "counts", compression="zstd")
        tf = pieces.join(divided, on, "left_anti")
    tf = tf.select(doc, F.inline("counts"))
    return _scored(tf.unionByName(merged) if several else tf, F.lit(float(n)), doc)


def compare_documents(
    scores: DataFrame, pairs: DataFrame, doc: str = "doc_id", value: str = "tfidf"
) -> DataFrame:
    """(doc_a, doc_b, cosine) for a table of document pairs of any size."""
    return pairwise_cosine(scores, pairs, doc, value)


def corpus_tfidf(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, tfidf) of a whole corpus with one document per row.

    Occurrences and documents of a term are counted in the same reading of the texts.
    """
    n = docs.agg(F.count(F.lit(1))).scalar().cast("double")
    counts = document_term_frequency(docs.select(text), text, []).groupBy("term")
    both = counts.agg(F.sum("tf").alias("tf"), F.log(n / F.count(F.lit(1))).alias("idf"))
    return both.select("term", tfidf_value())
