"""Ranked search against scoring every document for every item in plain Python."""

import collections
import math
import random
import re

import pytest

from termfit.llm import ranking
from tests.llm.common import FOLD, frame, odd_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plain_ranks(docs, items, best=50):
    counted = [(i, collections.Counter(terms(t))) for i, t in docs]
    n = sum(bool(c) for _, c in counted)
    total = sum(sum(c.values()) for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    rows = []
    for item_id, text in set(items):
        weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in set(terms(text))}
        scored = []
        for i, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total if total else 0
            score = sum(w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t, w in weights.items() if c[t])
            if score > 0:
                scored.append((-score, i is not None, i))
        rows += [(item_id, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:best])]
    return rows


def ranked(found):
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return collections.Counter(map(tuple, found.collect()))


def some_items(docs):
    rnd = random.Random(3)
    texts = [" ".join(rnd.sample(terms(t), min(12, len(terms(t))))) for _, t in docs[8:40:3]]
    items = [*enumerate(texts), (90, None), (91, ""), (92, "?!"), (93, "unheardof"), (94, "É é ÉÉ 🙂 x-y_z"), (None, texts[0])]
    return [*items, items[0], (95, "Same WORDS, again!")]


@pytest.mark.parametrize(("bucket", "chunk", "item_bytes"), [(1024, 4_000_000, 1 << 20), (4, 300, 100)])
def test_ranks_equal_scoring_everything(spark, monkeypatch, bucket, chunk, item_bytes):
    monkeypatch.setattr(ranking, "BUCKET", bucket)
    monkeypatch.setattr(ranking, "CHUNK", chunk)
    docs = odd_documents()
    items = some_items(docs)
    found = ranking.search(frame(spark, docs), frame(spark, items, "item_id bigint, text string"), item_bytes)
    assert ranked(found) == collections.Counter(plain_ranks(docs, items))


def test_many_equal_scores_keep_the_smallest_ids(spark):
    docs = [(i, "one two three") for i in range(300, 0, -1)] + [(1000, "one two"), (0, "four")]
    found = ranking.search(frame(spark, docs).repartition(7), frame(spark, [(1, "three one"), (2, "four")], "item_id bigint, text string"))
    assert ranked(found) == collections.Counter(plain_ranks(docs, [(1, "three one"), (2, "four")]))


def test_empty_tables_and_other_id_types(spark):
    docs, items = frame(spark, [(1, "a b")]), frame(spark, [(1, "a")], "item_id bigint, text string")
    assert ranking.search(docs.limit(0), items).count() == 0
    assert ranking.search(docs, items.limit(0)).count() == 0
    named = spark.createDataFrame([("x", "a b"), ("é", "a b"), (None, "a b"), ("z", "c")], "doc_id string, text string")
    found = ranking.search(named, spark.createDataFrame([("q", "a")], "item_id string, text string"))
    assert [(r.item_id, r.rank, r.doc_id) for r in found.orderBy("rank").collect()] == [("q", 1, None), ("q", 2, "x"), ("q", 3, "é")]


def test_bounds_skip_most_of_the_work(monkeypatch):
    """Few vectors are scored where most are short, or miss the item's heavy terms."""
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("abcdefghij") for _ in range(40)) for _ in range(3000)] + ["alpha beta gamma a"] * 60
    items = ranking._items(["alpha beta gamma a b"])
    plan = ranking.Plan(items, np.array([9000 if k > 1 else 10 for k in range(len(items.keys))], np.int64), 3060, 120_000)
    search, scored = ranking._Search(plan), []
    rescore = search._rescore
    monkeypatch.setattr(search, "_rescore", lambda *given: (scored.append(int(given[3].sum())), rescore(*given)))
    batch = pa.record_batch({"doc_id": list(range(len(texts))), "text": texts})
    search.add([ranking._vectors(batch, plan)])
    assert sum(scored) < len(texts) / 2 and len(search.found[0]) == 50
