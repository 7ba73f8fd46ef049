"""Removed bytes against a dictionary of all strings."""

import collections
import random

import pytest

from termfit.llm import repeats
from tests.llm.common import frame, odd_documents


def plain_removal(rows, length):
    count = collections.Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, t in texts:
        count.update(t[k : k + length] for k in range(len(t) - length + 1))
    result = collections.Counter()
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(bool(g) and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        result[i, len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone, strict=True) if not g)] += 1
    return result


@pytest.mark.parametrize(("length", "size"), [(20, 1 << 20), (200, 20_000), (7, 3_000)])
def test_removed_bytes(spark, length, size):
    rnd = random.Random(9)
    rows = [r for r in odd_documents() if len(r[1] or "") < 5000]
    passages = ["".join(rnd.choice("abé \n") for _ in range(rnd.randint(15, 260))) for _ in range(12)]
    for i in range(40):
        rows.append((2000 + i, "".join(rnd.choice(passages) if rnd.random() < 0.5 else str(rnd.random()) * 4 for _ in range(6))))
    rows += [(3000, "z" * 900), (3001, "ab" * 300), (3002, passages[0][:length]), (3003, "z" * length), (3004, "q" * (length - 1)), (3005, "q" * (length - 1))]
    found = repeats.remove_repeats(frame(spark, rows), length, block_bytes=size, range_bytes=size).collect()
    got = collections.Counter(
        (r.doc_id, r.n_bytes, sum(r.ends) - sum(r.starts), len(r.starts), bytes(r.kept)) for r in found
    )
    assert got == plain_removal(rows, length)


def test_empty_table(spark):
    assert repeats.digests(repeats.remove_repeats(frame(spark, []))).count() == 0
