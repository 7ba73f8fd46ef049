"""Small tables for the operators' tests, and words in plain Python."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns of the operators' own making, which the input may hold as well.
CLASH = {
    "n": "int", "row": "int", "a": "int", "b": "int", "spans": "int", "words": "int", "signature": "int", "ids": "int",
    "component": "int", "kept": "int", "owner": "int", "value": "int", "key": "int", "block": "int", "hash": "int",
}


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def odd_documents():
    """Nulls, empty and long texts, ties, repeated rows, and near copies."""
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(400)]
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One"), (6, "one two"), (None, "one two three four"), (7, "\x00 \ufffd 🙂 é")]
    for i in range(10, 60):
        text = " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(3, 120)))
        rows.append((i, text))
        for j in range(rnd.choice([0, 0, 1, 3])):
            parts = text.split(" ")
            for _ in range(rnd.randint(0, 3)):
                parts[rnd.randrange(len(parts))] = rnd.choice(vocabulary)
            rows.append((1000 + 10 * i + j, rnd.choice([" ", "\n", "  "]).join(parts)))
    long = " ".join(rnd.choice(vocabulary) for _ in range(60_000))
    rows += [(80, long), (81, long + " tail"), (82, "same words again " * 300), (83, "same words again " * 301), (84, "x" * 300_000)]
    rows += [rows[10], rows[10], (85, rows[12][1])]
    return rows


def frame(spark, rows, schema="doc_id bigint, text string", clash=True):
    df = spark.createDataFrame(rows, schema)
    if clash:
        for name, kind in CLASH.items():
            if name not in df.columns:
                df = df.selectExpr("*", f"cast(1 as {kind}) AS `{name}`")
    return df
