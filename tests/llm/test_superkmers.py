"""Removal of repeated windows against plain Python."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from termfit.llm import superkmers
from tests.llm.common import WORD, frame, odd_documents


def plain_removal(spark, rows):
    """Counted (doc_id, n_words, n_removed, kept)."""
    hashes = {(r.doc_id, r.text): r.h for r in frame(spark, rows, clash=False).selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h").collect()}
    seen, found = set(), {}
    for (i, text), _ in sorted(hashes.items(), key=lambda e: (e[0][0] is not None, e[0][0] or 0, e[1])):
        words = WORD.findall(text)
        gone = set()
        for at in range(len(words) - 19):
            window = tuple(words[at : at + 20])
            if window in seen:
                gone.update(range(at, at + 20))
            seen.add(window)
        found[i, text] = (i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    return collections.Counter(found[i, t or ""] for i, t in rows)


def passages():
    rnd = random.Random(2)
    name = lambda: "".join(rnd.choice("abcdeÉ") for _ in range(rnd.randint(1, 4)))
    shared = [[name() for _ in range(rnd.randint(18, 45))] for _ in range(6)]
    rows = []
    for i in range(80):
        words = [name() for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(words))
            words[at:at] = rnd.choice(shared)
        rows.append((100 - i, "".join(w + rnd.choice([" ", "\n", "  ", "\t"]) for w in words)))
    line = " ".join(name() for _ in range(12))
    rows += [(200 + i, " ".join([name() for _ in range(15)] + [line] + [name() for _ in range(15)])) for i in range(30)]
    rows += [(300, "same words " * 40), (301, "Same words " * 40), (302, "x " * 19), (303, "x " * 20), (304, "x " * 21), (5, rows[3][1]), rows[4], rows[4]]
    return [*rows, (50, "other text " + " ".join(shared[0]) + " here"), (None, " ".join(shared[1])), (None, " ".join(shared[2] + shared[1]))]


@pytest.mark.parametrize(("hot", "block_bytes", "range_bytes"), [(superkmers.HOT, 8 << 20, 64 << 20), (4, 2000, 3000), (1, 300, 500)])
def test_windows_that_came_before_go(spark, hot, block_bytes, range_bytes):
    rows = passages()
    found = superkmers.remove_repeats(frame(spark, rows), hot, block_bytes, range_bytes)
    assert collections.Counter(map(tuple, found.collect())) == plain_removal(spark, rows)


def test_odd_documents(spark):
    rows = odd_documents()
    found = superkmers.remove_repeats(frame(spark, rows), block_bytes=50_000)
    assert collections.Counter(map(tuple, found.collect())) == plain_removal(spark, rows)


def test_empty_tables_and_text_ids(spark):
    assert superkmers.remove_repeats(frame(spark, [])).count() == 0
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([("é", text), ("z", text), ("a", "x " + text)], "doc_id string, text string")
    assert {r.doc_id: r.n_removed for r in superkmers.remove_repeats(docs).collect()} == {"a": 0, "z": 25, "é": 25}


def test_many_equal_rows_become_one(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = frame(spark, [(7, text)] * 3000 + [(i, f"{i} {text}") for i in range(8, 20)], clash=False)
    assert superkmers._collapsed(docs).count() == 13
    found = superkmers.remove_repeats(docs).groupBy("doc_id", "n_removed").count().collect()
    assert {tuple(r) for r in found} == {(7, 0, 3000), *((i, 30, 1) for i in range(8, 20))}


def test_batches_of_one_bucket_know_what_came_before():
    rnd = random.Random(4)
    base = [rnd.choice("ab") for _ in range(200)]
    cuts = [(at, 20 + rnd.randint(0, 3)) for at in (rnd.randint(0, 170) for _ in range(400))]
    texts = [" ".join(base[at : at + n]) for at, n in cuts]
    rows = [(k // 100, k, t.count(" ") - 18, t.encode()) for k, t in enumerate(texts)]
    columns = [pa.array(c) for c in zip(*rows, strict=True)]
    whole = pa.record_batch({"key": columns[0], "start": columns[1], "n": columns[2], "words": columns[3], "block": columns[1], "ord": columns[1]})
    split = [whole.slice(at, 7) for at in range(0, 400, 7)]
    one, many = (pa.Table.from_batches(superkmers._repeats(iter(b))).column("mask").to_pylist() for b in ([whole], split))
    assert one == many and any(one)


def test_window_ranks():
    word = np.random.default_rng(3).integers(0, 2, 3000)
    word[1000:1100] = word[2000:2100]
    rank = superkmers._window_ranks(word)
    windows = [tuple(word[i : i + 20]) for i in range(2981)]
    assert len(rank) == 2981 and len(set(zip(windows, rank.tolist(), strict=True))) == len(set(windows)) == len(set(rank.tolist()))
