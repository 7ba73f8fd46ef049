"""Tokens, term frequency, document frequency and their product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfit.functions.text import split_tokens, term_array
from termfit.plans.joins import lookup
from termfit.session import durable


def tokenize(df: DataFrame, text: str = "text", keep: list[str] = ()) -> DataFrame:
    """(*keep, token): one row per whitespace-separated token."""
    return df.select(*keep, F.explode(split_tokens(F.col(text))).alias("token"))


def terms(df: DataFrame, text: str = "text", keep: list[str] = ()) -> DataFrame:
    """(*keep, term): one row per normalised, non-empty term."""
    return df.select(*keep, F.explode(term_array(F.col(text))).alias("term"))


def term_frequency(terms: DataFrame, by: list[str] = ()) -> DataFrame:
    """(*by, term, tf): occurrences of each term, over everything or per ``by`` columns."""
    return terms.groupBy(*by, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_term_frequency(
    docs: DataFrame, text: str = "text", keep: list[str] = ("doc_id",), packed: bool = False
) -> DataFrame:
    """(*keep, term, tf) when every row of ``docs`` is a whole document.

    With ``packed`` a row stays one row (*keep, counts): an array of its terms and their tf, NULL without terms.

    The terms of a row are sorted and their runs measured inside the row, so unlike
    ``term_frequency(terms, by)`` this needs no shuffle.
    """
    ordered = docs.select(*keep, F.sort_array(term_array(F.col(text))).alias("_terms"))
    # positions where a run starts; NULL, so no rows, for a document without terms
    first = "filter(sequence(1, size(_terms) - 1), i -> _terms[i] <> _terms[i - 1])"
    starts = ordered.select(
        *keep,
        "_terms",
        F.expr(
            "CASE WHEN size(_terms) = 1 THEN array(0) "
            f"WHEN size(_terms) > 1 THEN array_prepend({first}, 0) END"
        ).alias("_starts"),
    )
    run = "struct(_terms[s] AS term, CAST(coalesce(get(_starts, n + 1), size(_terms)) - s AS BIGINT) AS tf)"
    counts = f"transform(_starts, (s, n) -> {run})"
    return starts.select(*keep, F.expr(f"{counts} AS counts" if packed else f"inline({counts})"))


def top_terms(scores: DataFrame, k: int = 20, value: str | None = None) -> DataFrame:
    """The ``k`` largest of a (term, value) table; equal values rank by term."""
    value = value or scores.columns[-1]
    return scores.orderBy(F.col(value).desc(), F.col("term").asc()).limit(k)


def top_terms_from_text(df: DataFrame, k: int = 20, text: str = "text") -> DataFrame:
    """(term, tf): the ``k`` most frequent terms of a text table."""
    return top_terms(term_frequency(terms(df, text)), k)


def document_frequency(
    docs: DataFrame, text: str = "text", doc: str | None = None
) -> DataFrame:
    """(term, df): the number of documents that contain each term.

    Without ``doc`` every row is one document and repeats are removed inside the row.
    With ``doc``, rows that share its value form one document and repeats are removed
    by a shuffle on (document, term).
    """
    if doc is None:
        once = docs.select(F.explode(F.array_distinct(term_array(F.col(text)))).alias("term"))
    else:
        once = terms(docs, text, [doc]).dropDuplicates([doc, "term"])
    return once.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def inverse_document_frequency(
    docs: DataFrame, text: str = "text", doc: str | None = None
) -> DataFrame:
    """(term, df, idf) with idf = ln(N / df).

    N counts all documents, also those without any term.
    """
    n = docs.agg((F.count(F.lit(1)) if doc is None else F.count_distinct(doc)).alias("n"))
    ratio = n.scalar().cast("double") / F.col("df")
    return document_frequency(docs, text, doc).select("term", "df", F.log(ratio).alias("idf"))


def tfidf(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """tf's columns with ``tf`` replaced by ``tfidf``; terms without an idf drop out.

    The idf table is stored and measured. Beyond a broadcast its ``df``, where it has one, tells which terms are in so many
    documents that their rows have to be split.
    """
    keep = [name for name in tf.columns if name not in ("term", "tf")]
    idf = durable(idf)
    counts = idf.select("term", F.col("df").alias("count")) if "df" in idf.columns else None
    joined = lookup(tf, idf.select("term", "idf"), "term", by=[*keep, "tf"], counts=counts)
    return joined.select(*keep, "term", tfidf_value())


def tfidf_value() -> Column:
    return (F.col("tf") * F.col("idf")).alias("tfidf")
