import math
import random

import pytest

from termfit import compare_documents, cosine_similarity, pairwise_cosine, score_corpus
from termfit.operators.similarity import packed_vectors
from tests.test_text import DOCS


def table(spark, rows):
    return spark.createDataFrame(rows, "term string, value double")


def cosine(a, b):
    return cosine_similarity(a, b).first()["cosine"]


def test_single_pair(spark):
    a = table(spark, [("x", 3.0), ("y", 4.0)])
    b = table(spark, [("y", 2.0), ("z", 1.0)])
    assert cosine(a, b) == pytest.approx(8 / (5 * math.sqrt(5)))
    assert cosine(b, a) == pytest.approx(cosine(a, b))
    assert cosine(a, a) == pytest.approx(1.0)


def test_no_shared_term_is_zero_and_no_norm_is_null(spark):
    a = table(spark, [("x", 3.0)])
    assert cosine(a, table(spark, [("y", 1.0)])) == 0.0
    assert cosine(a, table(spark, [])) is None
    assert cosine(a, table(spark, [("x", 0.0)])) is None


def test_repeated_terms_multiply_out(spark):
    a = [("x", 1.0), ("x", 2.0), ("y", 1.0)]
    b = [("x", 3.0), ("x", 4.0)]
    numerator = sum(u * v for s, u in a for t, v in b if s == t)
    norms = math.sqrt(sum(u * u for _, u in a) * sum(v * v for _, v in b))
    assert cosine(table(spark, a), table(spark, b)) == pytest.approx(numerator / norms)


def golden_pairs(spark, compare):
    docs = spark.createDataFrame(DOCS, "doc_id string, text string")
    wanted = [("d1", "d2"), ("d1", "d3"), ("d1", "d4"), ("d1", "d1"), ("d2", "d1"), ("d1", "d2")]
    pairs = spark.createDataFrame(wanted, "doc_a string, doc_b string")
    rows = compare(score_corpus(docs), pairs).collect()
    found = {(r["doc_a"], r["doc_b"]): r["cosine"] for r in rows}
    assert len(rows) == len(found) == 5
    assert round(found["d1", "d2"], 6) == round(found["d2", "d1"], 6) == 0.196116
    assert found["d1", "d3"] == 0.0
    assert found["d1", "d4"] is None
    assert found["d1", "d1"] == pytest.approx(1.0)


def test_golden_pairs(spark):
    golden_pairs(spark, compare_documents)
    golden_pairs(spark, pairwise_cosine)


def test_golden_pairs_without_broadcast(spark, shuffled_joins):
    golden_pairs(spark, compare_documents)


def test_documents_travel_packed(spark, monkeypatch):
    """Behind the packing the exchanges carry arrays, and one exchange by pair is all there is."""
    from termfit.plans import joins

    scores = spark.createDataFrame([(d, f"t{t}", 1.0 + t) for d in range(6) for t in range(d, 40)], "doc_id int, term string, tfidf double")
    pairs = spark.createDataFrame([(0, 1), (2, 3), (5, 5)], "doc_a int, doc_b int")

    def shown():
        return pairwise_cosine(scores, pairs)._jdf.queryExecution().executedPlan().toString()

    above, below = shown().split("Generate inline(arrays_zip", 1)
    assert "Exchange" not in above and below.count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    above, below = shown().split("Generate inline(arrays_zip", 1)
    assert "Exchange" not in above and "Generate explode" in below  # copies per salt, no terms
    assert "_value#" not in below.split("\n", 1)[1]


def test_packed_rows_are_bounded(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        scores = spark.range(1000).selectExpr("id % 2 AS _doc", "concat('t', id) AS term", "double(id) AS _value").coalesce(1)
        packed = packed_vectors(scores).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(packed) == 20 and max(len(r["_terms"]) for r in packed) == 50
    assert sum(v for r in packed for v in r["_values"]) == sum(range(1000))


def test_hot_documents_equal_brute_force(spark, shuffled_joins, monkeypatch):
    """One document is in most pairs and another holds most scores; both get split."""
    from termfit.plans import joins

    monkeypatch.setattr(joins, "SHARES", 20)
    rng = random.Random(3)
    vectors = {
        d: {f"t{t}": rng.random() for t in rng.sample(range(400), 300 if d == 1 else 6)} for d in range(30)
    }
    pairs = [(0, d) for d in range(30)] + [(d, 1) for d in range(30)] + [(4, 5)]
    scores = spark.createDataFrame(
        [(d, t, v) for d, vector in vectors.items() for t, v in vector.items()],
        "doc_id int, term string, tfidf double",
    )
    found = compare_documents(scores, spark.createDataFrame(pairs, "doc_a int, doc_b int")).collect()
    assert len(found) == len(set(pairs))
    for a, b, value in found:
        dot = sum(v * vectors[b].get(t, 0.0) for t, v in vectors[a].items())
        norms = [math.sqrt(sum(v * v for v in vectors[d].values())) for d in (a, b)]
        assert value == pytest.approx(dot / (norms[0] * norms[1]))
        assert -1e-12 <= value <= 1 + 1e-12


def test_frequent_terms_stay_with_their_document(spark, monkeypatch):
    """A vocabulary beyond the broadcast limit is divided: only rows of its rare terms leave their document."""
    from termfit.plans import joins

    docs = [(d, " ".join(f"{'abcdefghij'[t]}x" * (1 + (d + t) % 3) for t in range(10)) + f" {'klmnopqrst'[d % 10] * (d + 1)}") for d in range(30)]
    docs += [(None, "ax kk"), (40, None), (41, "")]
    table = spark.createDataFrame(docs, "doc_id int, text string").coalesce(1)
    pairs = spark.createDataFrame([(d, d + 1) for d in range(30)] + [(3, 3), (0, 40)], "doc_a int, doc_b int")

    def found(**how):
        scores = score_corpus(table, **how)
        rows = compare_documents(scores, pairs).collect()
        return scores, {(r["doc_a"], r["doc_b"]): None if r["cosine"] is None else round(r["cosine"], 9) for r in rows}

    whole, wanted = found()
    assert len(wanted) == 32 and wanted[3, 3] == 1 and wanted[0, 40] is None
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 20 * (32 + 16 * 2 + 40))
    divided, cosines = found()
    assert cosines == wanted
    assert sorted(divided.collect(), key=str) == sorted(whole.collect(), key=str)
    assert "LeftAnti" in divided._jdf.queryExecution().executedPlan().toString()
    packed = packed_vectors(divided.selectExpr("doc_id AS _doc", "term", "tfidf AS _value")).where("size(_terms) >= 9")
    assert packed.count() >= 28  # not a row per term
    assert found(numbered=True)[1] == wanted
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    assert found()[1] == found(numbered=True)[1] == wanted
