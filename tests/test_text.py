import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from termfit import (
    document_frequency,
    document_term_frequency,
    inverse_document_frequency,
    normalize_term,
    score_corpus,
    term_array,
    term_frequency,
    terms,
    tfidf,
    tokenize,
    top_terms,
    top_terms_from_text,
)

DOCS = [
    ("d1", "Ba,Na:Na.123 banana!\nthe cat 42"),
    ("d2", "The cat sat. THE END"),
    ("d3", "dog dog, Dog"),
    ("d4", ""),
]
SCORES = {
    ("d1", "banana"): 2.772589,
    ("d1", "the"): 0.693147,
    ("d1", "cat"): 0.693147,
    ("d2", "the"): 1.386294,
    ("d2", "cat"): 0.693147,
    ("d2", "sat"): 1.386294,
    ("d2", "end"): 1.386294,
    ("d3", "dog"): 4.158883,
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id string, text string")


def python_terms(text):
    return [t for t in ("".join(c for c in w.lower() if c.isalpha()) for w in text.split()) if t]


def as_dict(df, *keys):
    return {tuple(row[k] for k in keys): row[len(keys)] for row in df.collect()}


@pytest.mark.parametrize(
    "raw, wanted",
    [
        ("B:a,n+a1n$a", ["banana"]),
        ("\u0130stanbul", ["istanbul"]),
        ("x\u00a0y", ["x", "y"]),
        ("a\u001cb", ["a", "b"]),
        ("123 ... ", []),
        ("\u00aa\u02b0\u8a9e", ["\u00aa\u02b0\u8a9e"]),
        ("", []),
        ("\u039f\u0394\u039f\u03a3 \u03a3\u0391\u03a3.", ["\u03bf\u03b4\u03bf\u03c2", "\u03c3\u03b1\u03c2"]),
    ],
)
def test_normalisation(spark, raw, wanted):
    row = spark.createDataFrame([(raw,)], "text string").select(term_array(F.col("text"))).first()
    assert row[0] == wanted


def test_whole_text_pass_equals_token_by_token(spark):
    rng = random.Random(5)
    alphabet = "abXY\u0130\u03a3\u00e9\u00df12.,:'\u00ad\u0301 \t\n\u00a0\u2003\u3000\u001d-\u8a9e"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    whole = {row["id"]: row["t"] for row in df.select("id", term_array(F.col("text")).alias("t")).collect()}
    tokens = tokenize(df, keep=["id"]).select("id", normalize_term(F.col("token")).alias("term"))
    single = Counter((r["id"], r["term"]) for r in tokens.where("term <> ''").collect())
    for i, text in enumerate(texts):
        assert whole[i] == python_terms(text)
        assert Counter(whole[i]) == Counter({t: n for (d, t), n in single.items() if d == i})


def test_term_frequency(docs):
    tf = as_dict(term_frequency(terms(docs)), "term")
    assert tf == {("the",): 3, ("dog",): 3, ("banana",): 2, ("cat",): 2, ("end",): 1, ("sat",): 1}
    assert sum(tf.values()) == terms(docs).count()


def test_term_frequency_in_rows_equals_grouping(spark, docs):
    rng = random.Random(1)
    words = ["a", "b", "c", "dd", "e1e", "F"]
    made = [(str(i), " ".join(rng.choice(words) for _ in range(rng.randrange(40)))) for i in range(50)]
    for table in (docs, spark.createDataFrame(made, "doc_id string, text string")):
        grouped = as_dict(term_frequency(terms(table, keep=["doc_id"]), ["doc_id"]), "doc_id", "term")
        assert as_dict(document_term_frequency(table), "doc_id", "term") == grouped


def test_null_text_has_no_terms(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "doc_id string, text string")
    assert as_dict(document_term_frequency(df), "doc_id", "term") == {("b", "x"): 1}
    assert terms(df).count() == 1


def test_top_terms_break_ties_by_term(docs):
    wanted = [("dog", 3), ("the", 3)]
    assert [tuple(r) for r in top_terms_from_text(docs, 2).collect()] == wanted
    assert [tuple(r) for r in top_terms(term_frequency(terms(docs)), 2).collect()] == wanted


def test_idf_counts_empty_documents(docs):
    idf = inverse_document_frequency(docs)
    values = {row["term"]: round(row["idf"], 6) for row in idf.collect()}
    assert values == {
        "banana": 1.386294,
        "sat": 1.386294,
        "end": 1.386294,
        "dog": 1.386294,
        "the": 0.693147,
        "cat": 0.693147,
    }


def test_documents_spread_over_rows(spark, docs):
    pieces = spark.createDataFrame(
        [(d, line) for d, text in DOCS for line in (text.split("\n") or [""])],
        "doc_id string, text string",
    )
    whole = as_dict(document_frequency(docs), "term")
    assert as_dict(document_frequency(pieces, doc="doc_id"), "term") == whole
    by_rows = as_dict(inverse_document_frequency(docs).select("term", "idf"), "term")
    by_key = as_dict(inverse_document_frequency(pieces, doc="doc_id").select("term", "idf"), "term")
    assert by_key == pytest.approx(by_rows)


def check_scores(scores):
    values = {k: round(v, 6) for k, v in as_dict(scores, "doc_id", "term").items()}
    assert values == SCORES


def test_scores(docs):
    tf = term_frequency(terms(docs, keep=["doc_id"]), ["doc_id"])
    check_scores(tfidf(tf, inverse_document_frequency(docs)))
    check_scores(score_corpus(docs))


def test_scores_without_broadcast(docs, shuffled_joins):
    check_scores(score_corpus(docs))


def test_terms_without_idf_drop(spark, docs):
    idf = spark.createDataFrame([("the", 1, 2.0)], "term string, df int, idf double")
    assert as_dict(tfidf(term_frequency(terms(docs)), idf), "term") == {("the",): 6.0}


def test_results_do_not_depend_on_partitioning(docs):
    assert as_dict(term_frequency(terms(docs.repartition(3))), "term") == as_dict(
        term_frequency(terms(docs.coalesce(1))), "term"
    )
