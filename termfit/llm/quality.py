"""Quality rules: simple text statistics, then a hashed n-gram log-likelihood ratio. Built-in functions only.

Two multinomials over hashed word unigrams and bigrams are compared: one counted on
trusted documents, one on the whole corpus. A document's score is its mean
log-likelihood ratio per n-gram, so that it does not depend on length. The threshold
lies below what trusted documents score without their own counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"
#: Size of the hashed feature space; the model on the driver has this many numbers.
BUCKETS = 10_000
#: At most this many labelled documents make up the trusted target (those with the smallest hashes of their ids).
TRUSTED_LIMIT = 20_000
#: Added to the target for every bucket that the corpus has, and dealt out like the corpus.
SMOOTHING = 1.0
#: Greatest threshold of the mean log-likelihood ratio per n-gram; ``fit_threshold`` lowers it where the target is small.
THRESHOLD = -0.07
#: Repeated windows up to this many are looked up one by one, beyond it they are sorted.
FEW = 32


def word_array(text: str) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a column; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def once(value: Column) -> Column:
    """The same value, held where it is computed.

    A filter further up would else be moved below this column and repeat its expression, inside lambdas
    even for every element.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def _features(words: Column) -> Column:
    """Buckets of the unigrams and bigrams as written (capitals tell quality too), as one array."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)))
    two = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1),
        lambda i: F.pmod(F.xxhash64(F.get(words, i - 1), F.get(words, i)), F.lit(BUCKETS)),
    )
    return F.when(F.size(words) > 1, F.concat(one, two)).otherwise(one)


def fit_counts(docs: DataFrame, trusted: DataFrame) -> tuple[list[int], list[int]]:
    """Target and corpus count of every bucket. ``trusted`` is (doc_id), bounded by TRUSTED_LIMIT.

    Both multinomials are counted over whole texts; the corpus one over all documents. Each distinct text
    counts once in either, trusted if one of its rows is, so that copies do not change the ratio.
    """
    ids = F.broadcast(trusted.select(F.col("doc_id").alias("_trusted")).distinct())
    marked = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_trusted"), "left")
    texts = marked.groupBy("text").agg(F.max(F.col("_trusted").isNotNull().cast("long")).alias("t"))
    counts = (
        texts.select("t", once(word_array("text")).alias("words"))
        .select("t", F.explode(_features(F.col("words"))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.sum("t").alias("target"), F.count("*").alias("corpus"))
        .collect()  # at most BUCKETS rows
    )
    target, corpus = [0] * BUCKETS, [0] * BUCKETS
    for bucket, t, c in counts:
        target[bucket] = t
        corpus[bucket] = c
    return target, corpus


def _added(corpus: list[int]) -> float:
    return SMOOTHING * sum(c > 0 for c in corpus)


def ratio_of(target: list[int], corpus: list[int]) -> list[float]:
    """log p_trusted - log p_corpus of every bucket; 0 where the corpus has nothing.

    The target is smoothed towards the corpus: a target that is small beside the smoothing scores about 0.
    """
    if not any(target):
        return [0.0] * BUCKETS
    whole, total, added = sum(target), sum(corpus), _added(corpus)
    shift = math.log(total) - math.log(whole + added)
    return [math.log(t + added * c / total) - math.log(c) + shift if c else 0.0 for t, c in zip(target, corpus, strict=True)]


def fit_ratio(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """The log ratio of every bucket, from the counts of ``fit_counts``."""
    return ratio_of(*fit_counts(docs, trusted))


def fit_threshold(docs: DataFrame, trusted: DataFrame, target: list[int], corpus: list[int]) -> float:
    """As far below the lowest hundredth of clean documents as that lies below their lowest quarter; THRESHOLD at most.

    The clean documents are the trusted ones that pass the base rules, each distinct text scored without its
    own counts in the target, as a document without a label is.
    """
    if not any(target):
        return THRESHOLD
    ids = F.broadcast(trusted.select("doc_id").distinct())
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").select("text").distinct()
    rows = texts.select(F.md5("text").alias("doc_id"), "text")  # named by what they say, whichever task reads them again
    clean = quality_rules(rows, [0.0] * BUCKETS, 0.0, ["doc_id", "text"]).where("kept").select("row.*")  # by the base rules
    words = clean.select("doc_id", once(word_array("text")).alias("words"))
    found = words.select("doc_id", once(_features(F.col("words"))).alias("found"))
    own = (
        found.select("doc_id", F.size("found").alias("n"), F.explode("found").alias("bucket"))
        .groupBy("doc_id", "n", "bucket")
        .agg(F.count("*").alias("own"))
    )

    def looked_up(values: list[int]) -> Column:
        return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast("array<double>"), F.col("bucket").cast("int"))

    added, total = _added(corpus), sum(corpus)
    like_corpus = looked_up(corpus) / total
    left = looked_up(target) - F.col("own") + added * like_corpus
    ratio = F.log(left / ((sum(target) - F.col("n") + added) * like_corpus))
    scores = own.select("doc_id", "n", (F.col("own") * ratio).alias("part")).groupBy("doc_id", "n").agg(F.sum("part").alias("total"))
    low = scores.agg(F.percentile(F.col("total") / F.col("n"), F.array(F.lit(0.01), F.lit(0.25))).alias("low")).first()["low"]
    return THRESHOLD if low is None else min(THRESHOLD, 2 * low[0] - low[1])


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_LIMIT) -> DataFrame:
    """A fixed, bounded choice of the documents labelled good and not toxic."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def _repeat_words(words: Column, grams: Column, ordered: Column) -> Column:
    """Words inside 3-word windows that occur at least twice. ``ordered`` holds the sorted windows."""
    # A window's neighbours in sorted order tell whether it repeats.
    repeated = F.array_distinct(
        F.filter(ordered, lambda g, i: F.when(i > 0, g == F.get(ordered, i - 1)).otherwise(False))
    )
    spots = F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))

    def by_lookup(few: Column) -> Column:
        return F.transform(F.filter(spots, lambda s: F.array_contains(few, s["g"])), lambda s: s["i"])

    def by_sorting(pairs: Column) -> Column:
        def same(i: Column, by: int) -> Column:
            return F.coalesce(F.get(pairs, i + by)["g"] == F.get(pairs, i)["g"], F.lit(False))

        twice = F.filter(pairs, lambda s, i: same(i, 1) | (F.when(i > 0, same(i, -1)).otherwise(False)))
        return F.sort_array(F.transform(twice, lambda s: s["i"]))

    def covered(at: Column) -> Column:
        """Size of the union of [i, i + 3) over ascending i."""
        steps = F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s)

    def let(value: Column, body) -> Column:
        """Name a value inside one expression, so that it is computed once."""
        return F.element_at(F.transform(F.array(value), body), 1)

    return let(
        repeated,
        lambda few: F.when(F.size(few) == 0, F.lit(0).cast("long"))
        .when(F.size(few) <= FEW, let(by_lookup(few), covered))
        .otherwise(let(F.sort_array(spots), lambda pairs: let(by_sorting(pairs), covered))),
    )


def quality_rules(
    docs: DataFrame, ratio: list[float], threshold: float = THRESHOLD, carry: list[str] | None = None
) -> DataFrame:
    """Judge every row of ``docs`` (doc_id, text). The columns named in ``carry`` come along as struct ``row``.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, llr (mean over the n-grams; 0 without words) and kept. A null text is
    empty and fails the base rules. Repeated rows are judged one by one; further columns
    of the input are ignored.
    """
    # A literal array that the optimizer folds once, instead of 10,000 literals in the plan.
    weights = F.split(F.lit(",".join(map(repr, ratio))), ",").cast("array<double>")
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = F.size("words")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(2), n - 1),
            lambda i: F.xxhash64(F.get("words", i - 2), F.get("words", i - 1), F.get("words", i)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(
        _features(F.col("words")),
        F.lit(0.0),
        lambda a, b: a + F.get(weights, b.cast("int")),
    )
    row = F.struct(*(F.col(c) for c in carry or [])).alias("row") if carry else F.lit(None).alias("row")
    step = docs.select(row, "doc_id", text.alias("text"), once(word_array("text")).alias("words"))
    step = step.select(
        "row",
        "doc_id",
        "words",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        windows.alias("windows"),
        F.when(n > 0, total).otherwise(0.0).alias("total"),
    )
    step = step.select(
        "row",
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "words",
        "windows",
        F.sort_array("windows").alias("ordered"),
        (F.col("total") / F.greatest(2 * F.col("n_words") - 1, F.lit(1))).alias("llr"),
    )
    step = step.select(
        "row",
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        _repeat_words(F.col("words"), F.col("windows"), F.col("ordered")).alias("n_repeat_words"),
        "llr",
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    step = step.withColumn("base_failed", failed).withColumn("kept", once(~failed & (F.col("llr") >= threshold)))
    return step if carry else step.drop("row")
