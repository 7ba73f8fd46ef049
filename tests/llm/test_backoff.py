"""Scores against counting in plain Python."""

import collections
import math
import zlib

import pytest

from termfit.llm import backoff
from tests.llm.common import frame, odd_documents, words


def plain_scores(rows):
    texts = [(i, zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1, [*words(t), None]) for i, t in rows]
    one, two = collections.Counter(), collections.Counter()
    for _, held_out, tokens in texts:
        if not held_out:
            one.update([("word", t) for t in tokens] + ["begin"])
            two.update(zip(["begin", *[("word", t) for t in tokens]], tokens, strict=False))
    n, v = sum(c for k, c in one.items() if k != "begin"), len([k for k in one if k != "begin"])
    power = math.log(v) / math.log(n) if n > 1 and v > 1 else 1.0
    result = []
    for i, held_out, tokens in texts:
        base = score = 0.0
        state = "begin"
        for t in tokens:
            root = (one["word", t] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(root)
            c = one[state]
            if c:
                fail = c**power / (c + c**power)
                score += math.log10((1 - fail) * two[state, t] / c + fail * root)
            else:
                score += math.log10(root)
            state = ("word", t)
        result.append((i, held_out, len(tokens), sum(one["word", t] > 0 for t in tokens), n, round(base, 6), round(score, 6)))
    return result


@pytest.mark.parametrize("size", [4 << 20, 50_000])
def test_scores(spark, size):
    rows = odd_documents()
    found = backoff.score(frame(spark, rows), block_bytes=size, range_bytes=size).collect()
    got = collections.Counter((*r[:5], round(r.base_score, 6), round(r.score, 6)) for r in found)
    for key in (got - collections.Counter(plain_scores(rows))), (collections.Counter(plain_scores(rows)) - got):
        assert not key


def test_scores_of_an_empty_table_and_without_training(spark):
    assert backoff.score(frame(spark, [])).count() == 0
    held = next(i for i in range(100) if backoff.is_held_out(i))
    row = backoff.score(frame(spark, [(held, "a b")])).first()
    assert row.n_known == 0 and row.train_tokens == 0 and row.score == row.base_score
