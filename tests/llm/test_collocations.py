"""Collocations against counting in plain Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from termfit.llm import collocations
from tests.llm.common import FOLD, frame, odd_documents


def plain_collocations(rows, least, top):
    counts, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in (1, 2, 3):
                counts.update((lang or "und", *words[i : i + size]) for i in range(len(words) - size + 1))
    found = collections.defaultdict(list)
    for (lang, *words), a in counts.items():
        if len(words) < 2 or a < least:
            continue
        longer = [c for (g, *other), c in counts.items() if g == lang and len(other) > len(words) and c >= least
                  and tuple(words) in [tuple(other[i : i + len(words)]) for i in range(len(other) - len(words) + 1)]]
        if any(100 * c >= 50 * a for c in longer):
            continue
        cuts = [(counts[lang, *words[:k]], counts[lang, *words[k:]]) for k in range(1, len(words))]
        score, k = min((1000000 * a * a // (left * right), k) for k, (left, right) in enumerate(cuts))
        found[lang].append((-score, -a, " ".join(words).encode(), *cuts[k]))
    return sorted(
        (lang, rank + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, phrases in found.items()
        for rank, (s, a, p, left, right) in enumerate(sorted(phrases)[:top])
    )


def spoken():
    rnd = random.Random(11)
    marks = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "! ", "\x0b", ";", "\x0d\x0a"]
    rows = [(None, "a b a b a b a b"), ("und", "A b, a B"), ("en", None), ("fr", ""), ("en", " .,\n"), ("en", "a b É é 🙂 \x00 x")]
    for lang in ("en", "fr", None):
        words = ["".join(rnd.choice("abé") for _ in range(rnd.randint(1, 3))) for _ in range(25)] + ["new york city", "of the"]
        rows += [(lang, "".join(rnd.choice(words) + rnd.choice(marks) for _ in range(rnd.randint(1, 300)))) for _ in range(12)]
    return [*rows, *rows[10:14], ("en", "the of the " * 5_000)]


@pytest.mark.parametrize(("slice_bytes", "range_bytes", "least", "top"), [(8 << 20, 16 << 20, 3, 50), (500, 400, 4, 2000)])
def test_collocations(spark, monkeypatch, slice_bytes, range_bytes, least, top):
    monkeypatch.setattr(collocations, "SLICE_BYTES", slice_bytes)
    rows = spoken()
    found = collocations.collocations(frame(spark, rows, "lang string, text string"), least, top, range_bytes)
    assert dict(found.dtypes) == {c: "string" if c in ("lang", "phrase") else "bigint" for c in found.columns}
    assert sorted(map(tuple, found.collect())) == plain_collocations(rows, least, top)


def test_odd_texts_and_empty_tables(spark):
    rows = [("en", t) for _, t in odd_documents()]
    found = collocations.collocations(frame(spark, rows, "lang string, text string")).collect()
    assert sorted(map(tuple, found)) == plain_collocations(rows, 10, 2000)
    assert collocations.collocations(frame(spark, [], "lang string, text string")).count() == 0


def test_scores_beyond_64_bits(spark):
    rows = [(10**15, 10**15, 10**15), (987654321012345, 999999999999999, 987654321012345), (10, 10**15, 10**15), (3 * 10**12, 4 * 10**12, 5 * 10**12)]
    found = spark.createDataFrame(rows, "a bigint, l bigint, r bigint").select(collocations._score("a", "l", "r").alias("score"))
    assert [r.score for r in found.collect()] == [1000000 * a * a // (left * right) for a, left, right in rows]


def test_many_words_need_no_wide_codes():
    """Triples over so many words that three places do not fit 62 bits are added up just as well."""
    rnd = np.random.default_rng(1)
    vocabulary = pa.array([f"{i:07}" for i in range(3_000_000)], pa.large_string())
    places = [rnd.integers(0, 3_000_000, 1000).repeat(2) for _ in range(3)]
    summed = collocations._summed(vocabulary, [p[::-1] for p in places], None)
    rows = list(zip(*(p.tolist() for p in summed.places), strict=True))
    assert rows == sorted(set(zip(*(p.tolist() for p in places), strict=True))) and set(summed.count.tolist()) == {2}


def test_a_common_pair_is_dealt_out(spark):
    """The triples of one pair reach many ranges, and the next level one entry of it per range at most."""
    texts = pa.array([f"of the x{i}" for i in range(2000)])
    dealt = list(collocations._dealt(collocations.count_texts(texts), "en", 20))
    sizes = [len(collocations._unpack(s, 3).count) for _, s in dealt]
    assert len(dealt) == 20 and max(sizes) < 2 * sum(sizes) / 20
    table = pa.table({"lang": ["en"] * 1, "range": [dealt[0][0]], "stream": [dealt[0][1]]})
    heads = collocations._merge(3, 1, 10)(table).filter(pa.compute.field("kind") == "stream")
    counts = collocations._unpack(heads.column("stream")[0].as_py(), 2)
    assert sorted(counts.count.tolist())[-1] > 30 and len(counts.count) == len(set(zip(*(p.tolist() for p in counts.places), strict=True)))


def test_merge_joins_only(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = collocations.collocations(frame(spark, spoken(), "lang string, text string"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "HashJoin" not in plan and "SortMergeJoin" in plan
