"""Every stage of the pipeline, and all of them, against plain Python."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from termfit.llm import queries
from tests.llm.common import frame, words

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
STAGES = dict(pipeline.STAGES)


def text(seed, n=120):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(n))


ITEM = text("item", 40)


def changed(given, at):
    parts = given.split(" ")
    parts[at] = "changed"
    return " ".join(parts)


def documents():
    first, other = text(1), text(4)
    secret = other + ' password = "hunter2secret" ' + text(40, 20)
    texts = [
        (1, first), (2, first), (3, changed(first, 60)), (4, secret), (5, text(5, 60) + " " + ITEM + " " + text(50, 30)), (6, "too short"), (7, None), (8, ""),
        (None, text(9)), (None, text(9)), (10, text(10)), (10, text(11)), (12, text(12)), (12, text(12)), (13, text(13, 5000) + " É 🙂"), (14, "same words again " * 60),
        (15, changed(changed(text(10), 20), 90)), (16, text(5, 60) + " " + text(51, 60)),
    ]
    return [(i, t, "en" if i != 4 else None, f"src{i or 0}", len(t or "")) for i, t in texts]


def after_quality(rows):
    kept = []
    for row in rows:
        found = words(row[1])
        grams = collections.Counter(zip(found, found[1:], found[2:], strict=False))
        covered = {i + k for i, g in enumerate(zip(found, found[1:], found[2:], strict=False)) if grams[g] > 1 for k in range(3)}
        if len(found) >= 50 and 100 * len(covered) <= 50 * len(found):
            kept.append(row)
    return kept


def after_near_duplicates(rows):
    def shingles(t):
        w = words(t)
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    named = sorted({(r, shingles(r[1])) for r in rows if r[0] is not None and words(r[1])}, key=lambda e: (e[0][0], e[0][1]))
    group = list(range(len(named)))
    for i, (_, a) in enumerate(named):
        for j in range(i):
            if 5 * len(a & named[j][1]) >= 4 * len(a | named[j][1]):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return [named[g][0] for g in sorted(set(group))] + [r for r in rows if r[0] is None or not words(r[1])]


def after_decontamination(rows):
    return [r for r in rows if ITEM not in (r[1] or "")]


def after_secrets(rows):
    masked = []
    for i, t, lang, source, _ in rows:
        t = None if t is None else t.replace('password = "hunter2secret', "[secret]")  # the closing quote is not part of the match
        masked.append((i, t, lang, source, None if t is None else len(t)))
    return masked


def after_tokens(rows):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(queries.bpe_path())
    ids = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    return [(i, len(found), tuple(found)) for i, found in ids]


PLAIN = dict(zip(STAGES, (after_quality, after_near_duplicates, after_decontamination, after_secrets, after_tokens), strict=True))


def counted(df):
    return collections.Counter(tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in df.collect())


def written(spark, folder, rows, trusted=()):
    frame(spark, rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    frame(spark, [(0, ITEM), (1, None), (2, "")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    frame(spark, list(trusted), "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.mark.parametrize("name", STAGES)
def test_stage(spark, tmp_path, name):
    """Each stage is given all documents, whatever the stages before it would have kept."""
    folder = written(spark, tmp_path, documents())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = STAGES[name](spark, docs, folder)
    wanted = PLAIN[name](documents())
    if name == "secret scans":  # a missing text is empty to the scan
        found = found.select(*[F.when(F.col("text") == "", None).otherwise(F.col(c)).alias(c) if c in ("text", "n_chars") else F.col(c) for c in found.columns])
        wanted = [(i, t or None, lang, source, n if t else None) for i, t, lang, source, n in wanted]
    if name != "BPE encoding":
        assert found.columns == pipeline.COLUMNS
    assert counted(found) == collections.Counter(wanted)


@pytest.mark.parametrize("name", STAGES)
def test_stage_of_an_empty_table(spark, tmp_path, name):
    folder = written(spark, tmp_path, [])
    assert STAGES[name](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).count() == 0


def test_run(spark, tmp_path):
    rows = documents()
    for plain in PLAIN.values():
        rows = plain(rows)
    found = pipeline.run(spark, written(spark, tmp_path, documents()))
    assert found.columns == ["doc_id", "n_tokens", "ids"]
    assert counted(found) == collections.Counter(rows)
    assert [i for i, *_ in rows].count(10) == 2 and {1, 4, 12, 13, 16} <= {i for i, *_ in rows}


def test_only_likely_near_duplicates_are_verified(spark, monkeypatch):
    """Sets travel whole only for pairs whose sizes and parities do not tell them apart; nothing similar is ruled out."""
    from termfit.llm import jaccard

    seen, verify = [], jaccard.verify
    monkeypatch.setattr(jaccard, "verify", lambda pairs, sets, t: seen.append(pairs.count()) or verify(pairs, sets, t))
    rows = []
    for i in range(0, 300, 3):
        first = text(i, 300)
        rows += [(i, first), (i + 1, changed(first, 150)), (i + 2, text(i + 1, 60 + i))]
    rnd = random.Random(5)
    for i in range(300, 340):  # around the threshold
        parts = text(0, 300).split(" ")
        for at in rnd.sample(range(300), rnd.randint(3, 9)):
            parts[at] = f"w{i}"
        rows.append((i, " ".join(parts)))
    full = [(i, t, "en", "s", len(t)) for i, t in rows]
    wanted = sorted(r[0] for r in after_near_duplicates(full))
    docs = frame(spark, full, SCHEMA)
    assert sorted(r["doc_id"] for r in jaccard.first_of_groups(docs).collect()) == wanted
    assert sum(seen) < 500
    monkeypatch.setattr(jaccard, "SMALL", 1)  # all groups by their differences
    assert sorted(r["doc_id"] for r in jaccard.first_of_groups(docs).collect()) == wanted


def test_longest_match_tries_no_longer_tokens_than_there_are():
    """The longest match is found without asking for lengths that no token with these first characters has."""
    from termfit.llm import bpe

    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

    encoder = bpe.WordBpe.__new__(bpe.WordBpe)
    encoder.inner = Counted({c: i for i, c in enumerate("abc")} | {"ab": 3, "a" * 20: 4})
    encoder.final, encoder.longest_final, encoder.longest = {"a": 5, "b": 6, "c": 7, "bc": 8}, 2, 20
    encoder.reach = {"a": 1, "b": 1, "c": 1, "ab": 2, "aa": 20}
    assert encoder.propose("cb" * 50 + "abc") == [2, 1] * 50 + [3, 7]
    assert encoder.inner.asked == 101
    assert encoder.propose("a" * 20 + "bc") == [4, 8]
