"""How the set join deals out signatures and compares the members of a group."""

import collections
import random
from fractions import Fraction

import pyarrow as pa
import pytest

from termfit.llm import jaccard
from termfit.llm.words import shingle_sets
from tests.llm.common import frame
from tests.llm.test_first import clustered_documents, plain_components


def grouped_documents():
    """Texts that share a passage and else nothing, and near copies among them: large groups with many components."""
    rnd = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for k in range(60):
        own = passage + [f"k{k}x{i}" for i in range(rnd.randint(20, 160))]
        for j in range(rnd.choice([1, 1, 2, 4])):
            parts = list(own)
            for _ in range(rnd.randint(0, 4)):
                parts[rnd.randrange(40, len(parts))] = f"e{rnd.randrange(10**6)}"
            rows.append((100 * k + j, " ".join(parts)))
    return rows


@pytest.mark.parametrize(("size", "threshold", "block", "partners"), [(5, Fraction(4, 5), 7, 1), (1, Fraction(2, 5), 4096, 16)])
def test_groups_are_compared_block_by_block(spark, monkeypatch, size, threshold, block, partners):
    """No member's differences travel, whatever the size of blocks and however few partners are named at once."""
    monkeypatch.setattr(jaccard, "SMALL", 1)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "PARTNERS", partners)
    monkeypatch.setattr(jaccard, "_by_difference", None)
    rows = clustered_documents() + grouped_documents()
    members, _ = jaccard.jaccard_components(frame(spark, rows), size, threshold)
    assert collections.Counter(tuple(r) for r in members.collect()) == plain_components(rows, size, threshold)


def test_very_large_groups_go_by_differences(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 1)
    monkeypatch.setattr(jaccard, "LARGE", 2)
    rows = clustered_documents() + grouped_documents()
    members, _ = jaccard.jaccard_components(frame(spark, rows))
    assert collections.Counter(tuple(r) for r in members.collect()) == plain_components(rows, 5, Fraction(4, 5))


def test_signatures_are_packed():
    """All members of a bucket meet its first one, and a signature takes less than 8 bytes with its set."""
    texts = pa.array([t for _, t in clustered_documents() + grouped_documents()] * 2)
    row, key = shingle_sets(texts, 5)
    _, _, node = jaccard._class_keys(row, key, len(texts))
    scheme = jaccard.make_scheme({e: 1000 for e in range(10)}, Fraction(4, 5))
    wanted = collections.defaultdict(set)
    for r, s in zip(*jaccard._signatures(row, key, len(texts), scheme), strict=True):
        wanted[int(s)].add(int(node[r]))
    batches = [pa.RecordBatch.from_arrays([texts.slice(at, 40)], ["text"]) for at in range(0, len(texts), 40)]
    dealt = pa.Table.from_batches(jaccard._dealt(5, scheme, 3)(iter(batches)))
    ranges = dealt.column("range").to_pylist()
    assert {r for r in ranges if r >= 0} == {0, 1, 2}
    met = [jaccard._met(dealt.filter(pa.array([r == x for r in ranges]))).to_pylist() for x in sorted(set(ranges))]
    nodes = {r["place"]: r["node"] for part in met for r in part if r["first"] is None}
    assert set(nodes.values()) == set(node.tolist())
    stars = {(nodes[r["first"]], nodes[r["place"]]) for part in met for r in part if r["first"] is not None}
    for members in wanted.values():
        assert len(members) == 1 or any(all(x == first or (first, x) in stars for x in members) for first in members)
    entries = sum(len(jaccard.unpack_keys(p)) for r, p in zip(ranges, dealt.column("packed").to_pylist(), strict=True) if r >= 0)
    packed = pa.compress(b"".join(p for r, p in zip(ranges, dealt.column("packed").to_pylist(), strict=True) if r >= 0), "lz4", asbytes=True)
    assert len(packed) < 8 * entries


def test_a_pair_is_found_once_and_asked_once(spark, monkeypatch):
    """Neither ranges of buckets that two sets share nor further rounds of partners repeat a pair."""
    monkeypatch.setattr(jaccard, "RANGE", 1000)
    monkeypatch.setattr(jaccard, "SMALL", 1)
    monkeypatch.setattr(jaccard, "PARTNERS", 1)
    met, asked = [], []

    class Scratch(jaccard._Scratch):
        def __call__(self, df, name):
            table = super().__call__(df, name)
            if name == "met":
                met.extend((r["first"], r["place"]) for r in table.collect() if r["first"] is not None)
            return table

    def verified(docs, classes, pairs, *more, plain=jaccard._verified):
        asked.append({tuple(sorted(r)) for r in pairs.select("a", "b").collect()})
        return plain(docs, classes, pairs, *more)

    monkeypatch.setattr(jaccard, "_Scratch", Scratch)
    monkeypatch.setattr(jaccard, "_verified", verified)
    rows = clustered_documents() + grouped_documents()
    members, _ = jaccard.jaccard_components(frame(spark, rows), 1, Fraction(2, 5))
    assert collections.Counter(tuple(r) for r in members.collect()) == plain_components(rows, 1, Fraction(2, 5))
    assert met and len(met) == len(set(met))
    assert len(asked) > 2 and not asked[1] & asked[2]


def test_further_links_join_components(spark):
    """Labels after further links are those of all links together, also for ends that had no link before."""
    rnd = random.Random(5)
    links = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)]
    table = lambda rows: spark.createDataFrame(rows, "a bigint, b bigint")
    stored = jaccard._Scratch(spark)
    labels = jaccard.components(table(links[:80]), stored)
    assert jaccard._merged(labels, table([]), stored) is labels
    merged = jaccard._merged(labels, table(links[80:]), stored)
    wanted = {tuple(r) for r in jaccard.components(table(links), stored).collect()}
    assert {tuple(r) for r in merged.collect() if any(r[0] in (a, b) and a != b for a, b in links)} == wanted


def test_rounds_of_partners_do_not_repeat_each_other():
    """Every pair of different components is named by one round; merged ones hide none behind them."""
    count = 20
    columns = {c: [0] * count for c in ("low", "high", "part")} | {c: list(range(count)) for c in ("node", "known", "component")}
    group = pa.table(columns | {"n_shingles": [10] * count, "sketch": pa.array([[7]] * count, pa.list_(pa.int64()))})
    rounds = [jaccard._close(Fraction(4, 5), *span)(group).to_pylist() for span in ((0, 2), (2, 8), (8, 64))]
    assert sorted((r["a"], r["b"]) for part in rounds for r in part) == [(a, b) for a in range(count) for b in range(a + 1, count)]
    assert [any(r["more"] for r in part) for part in rounds] == [True, True, False]
    merged = group.set_column(group.schema.get_field_index("component"), "component", pa.array([0] * (count - 1) + [count]))
    assert all(r["more"] for r in jaccard._close(Fraction(4, 5), 2, 4)(merged).to_pylist() if r["a"] < 10)
    assert {r["a"] for r in jaccard._close(Fraction(4, 5), 2, 4)(merged).to_pylist()} >= set(range(10))
