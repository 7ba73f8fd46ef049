"""Found templates against all word runs in plain Python."""

import random

import pytest
import regex as re

from termfit.llm import licenses
from tests.llm.common import frame, odd_documents, words


def test_layouts():
    for n in range(5, 300):
        p = licenses.layout(n)
        assert p.window - n >= p.stride - 1  # every run of n words lies in a window
        own, inside = n - 4, p.window - 4
        shared = -(-8 * own // 10)
        j = shared / (own + inside - shared)
        assert 1 - (1 - j**p.rows) ** p.bands >= licenses.CERTAINTY


def test_scan(spark):
    rnd = random.Random(10)
    fill = lambda n: " ".join(f"w{rnd.randrange(500)}" for _ in range(n))
    names = sorted(licenses.TEMPLATES)
    rows = list(odd_documents())
    expected = set()
    for i in range(60):
        name = rnd.choice(names)
        text = licenses.TEMPLATES[name]
        if i % 3 == 0:
            text = text.upper()
        if i % 5 == 0 and len(words(text)) > 40:  # one changed word spoils five shingles
            parts = text.split(" ")
            parts[20] = "zzz"
            text = "\n".join(parts)
        rows.append((5000 + i, f"{fill(rnd.randrange(80))} {text} {fill(rnd.randrange(80))}"))
        expected.add((5000 + i, name))
    half = licenses.TEMPLATES["MIT-text"].split(" ")
    rows.append((6000, " ".join(half[: len(half) // 2])))
    rows += [(6001, licenses.TEMPLATES["MIT"])] * 2
    expected.add((6001, "MIT"))
    found = licenses.scan(frame(spark, rows)).collect()
    got = {(r.doc_id, r.license_id) for r in found}
    assert expected <= got and len(got) == len(found)
    shingle = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    texts = dict(rows)
    for r in found:  # nothing that a plain check refuses
        template = shingle(plain_words(licenses.TEMPLATES[r.license_id]))
        assert len(template & shingle(plain_words(texts[r.doc_id]))) >= 0.8 * len(template)
        assert r.containment >= 0.8


def test_commented_headers(spark):
    rows, expected = [], set()
    for i, name in enumerate(("Apache-2.0-header", "MIT-text", "GPL-3.0-header")):
        parts = licenses.TEMPLATES[name].split(" ")
        lines = [" ".join(parts[k : k + 11]) for k in range(0, len(parts), 11)]
        for j, mark in enumerate((" * ", "# ", "// ", "#")):
            rows.append((10 * i + j, "/*\n" + "\n".join(mark + x for x in lines) + "\n */\nint x;"))
            expected.add((10 * i + j, name))
    assert expected <= {(r.doc_id, r.license_id) for r in licenses.scan(frame(spark, rows)).collect()}


def plain_words(text):
    trimmed = (re.sub(r"^[^\p{L}\p{N}\p{M}]+|[^\p{L}\p{N}\p{M}]+$", "", w) for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()))
    return [w for w in trimmed if w]


def test_scan_finds_what_a_search_over_all_windows_finds(spark):
    rnd = random.Random(12)
    names = sorted(licenses.TEMPLATES)
    rows = list(odd_documents())
    for i in range(120):
        parts = licenses.TEMPLATES[names[i % len(names)]].split(" ")
        for _ in range(rnd.randint(0, len(parts) // 12)):  # near the share that is asked for, on either side
            parts[rnd.randrange(len(parts))] = rnd.choice(["zzz", "license", "software"])
        low = rnd.choice([0, 0, 2])
        rows.append((5000 + i, " ".join(f"w{rnd.randrange(99)}" for _ in range(rnd.randrange(60))) + " -- " + " ".join(parts[low:])))
    shingles = lambda w: [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    wanted = {}
    for i, text in rows:
        there = shingles(plain_words(text))
        for name, template in licenses.TEMPLATES.items():
            asked = set(shingles(plain_words(template)))
            p = licenses.layout(len(plain_words(template)))
            inside = p.window - 4
            shares = [len(asked & set(there[k : k + inside])) / len(asked) for k in range(0, max(1, len(there)), p.stride)]
            if max(shares) >= 0.8:
                wanted[i, name] = max(wanted.get((i, name), 0), max(shares))
    found = {(r.doc_id, r.license_id): r.containment for r in licenses.scan(frame(spark, rows)).collect()}
    assert found == pytest.approx(wanted) and len(wanted) > 60


def test_needed_words_cover_every_share():
    rnd = random.Random(2)
    for text in licenses.TEMPLATES.values():
        words_ = plain_words(text)
        shingles = sorted({tuple(words_[k : k + 5]) for k in range(len(words_) - 4)})
        needed = licenses.needed_words(words_)
        least = -(-8 * len(shingles) // 10)
        bare = [s for s in shingles if not any(w in s for w in needed)]
        assert len(bare) < least and len(needed) < 16
        assert all(any(w in s for w in needed for s in rnd.sample(shingles, least)) for _ in range(50))


def test_punctuation_at_the_ends_of_words(spark):
    rows = [(1, "Licensed under CC BY-NC 4.0"), (2, "Released under the MIT License"), (3, '"Licensed under the Apache License, Version 2.0"'), (4, "=" * 300_000 + " x " + "-" * 300_000)]
    rows += [(5, "(Released) [under] *the* _MIT_ license!?"), (6, "Released under the MIT-License")]
    found = {(r.doc_id, r.license_id) for r in licenses.scan(frame(spark, rows)).collect()}
    assert found == {(1, "CC-BY-NC-4.0"), (2, "MIT"), (3, "Apache-2.0"), (5, "MIT")}
    words_ = spark.createDataFrame([(r[1],) for r in rows], "text string").select(licenses._words("text").alias("w")).collect()
    assert [[w.lower() for w in r.w] for r in words_] == [plain_words(t) for _, t in rows]


def test_empty_tables(spark):
    assert licenses.scan(frame(spark, [])).count() == 0
    assert licenses.scan(frame(spark, [(1, "a b c d e f")]), {}).count() == 0
    assert licenses.scan(frame(spark, [(1, "a b c d e f")]), {"x": "too short"}).count() == 0
