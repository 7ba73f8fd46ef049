"""URL filters: rules first, then logistic regression on hashed character n-grams. Built-in functions only.

The model has BUCKETS weights over n-grams of host and path (each marked with the part it comes from,
with ends marked, rows scaled to length 1) and an intercept. It is fitted to a small table of labelled URLs
by accelerated gradient descent: every step sums one gradient per bucket on the executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfit.session import scratch_path

BUCKETS = 8192
SIZES = (3, 4)
#: At most this many distinct labelled URLs are used (those with the smallest hashes).
LABELLED_LIMIT = 5_000
STEPS = 25
L2 = 1e-4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class UrlModel:
    weights: list[float]
    intercept: float


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path. Both are empty for null and where there is no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _LOWER), F.regexp_extract(url, pattern, 2)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls. ``rules`` is a short configured list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(str(rule))).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _grams(text: Column, mark: str) -> Column:
    """Buckets of the character n-grams of one part, in time linear in its length."""
    marked = F.concat(F.array(F.lit("\x02")), F.array_remove(F.split(text, ""), ""), F.array(F.lit("\x03")))

    def of(letters: Column, size: int) -> Column:
        def bucket(i: Column) -> Column:
            return F.pmod(F.xxhash64(F.lit(mark), *(F.get(letters, i + k) for k in range(size))), F.lit(BUCKETS))

        spots = F.sequence(F.lit(0), F.greatest(F.size(letters) - size, F.lit(0)))
        return F.when(F.size(letters) >= size, F.transform(spots, bucket)).otherwise(F.array().cast("array<bigint>"))

    # the letters are the variable of an outer function: a lambda would split the text again for every n-gram
    return F.element_at(F.transform(F.array(marked), lambda letters: F.concat(*(of(letters, size) for size in SIZES))), 1)


def features(host: Column, path: Column) -> Column:
    return F.concat(_grams(host, "h"), _grams(path, "p"))


def _literal(weights: list[float]) -> Column:
    """An array that the optimizer folds to one constant."""
    return F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")


def margin(grams: Column, model: UrlModel) -> Column:
    """Log-odds of ``block``: the mean weight of the n-grams, scaled by the root of their number."""
    weights = _literal(model.weights)
    total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(weights, g.cast("int")))
    return total / F.sqrt(F.greatest(F.size(grams), F.lit(1))) + F.lit(model.intercept)


def train(labelled: DataFrame, steps: int = STEPS, limit: int = LABELLED_LIMIT) -> UrlModel:
    """Fit the model to labelled URLs (url STRING, block BOOLEAN).

    Repeated URLs with one label count once; rows with a null are left out. Without rows, or with
    one class only, all weights are 0 and the intercept tells that class (allow, if there are no rows).
    """
    spark = labelled.sparkSession
    rows = labelled.where("url IS NOT NULL AND block IS NOT NULL").select("url", "block").distinct()
    rows = rows.orderBy(F.xxhash64("url"), "url", "block").limit(limit)
    grams = features(*url_parts(F.col("url")))
    path = scratch_path(spark, "labelled-urls")
    rows.select(F.col("block").cast("double").alias("y"), grams.alias("grams")).write.parquet(path)
    rows = spark.read.parquet(path)
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    weights = [0.0] * BUCKETS
    if positive in (0, n):
        return UrlModel(weights, -1.0 if positive == 0 else 1.0)
    intercept = math.log(positive / (n - positive))
    ahead, ahead_intercept, pace = weights, intercept, 1.0
    for _ in range(steps):
        excess = 1 / (1 + F.exp(-margin(F.col("grams"), UrlModel(ahead, ahead_intercept)))) - F.col("y")
        pulls = rows.select(F.explode(F.concat(F.array(F.lit(-1)), "grams")).alias("g"), excess.alias("e"), F.size("grams").alias("n"))
        scaled = F.when(F.col("g") < 0, F.col("e")).otherwise(F.col("e") / F.sqrt("n"))
        gradient = dict(pulls.groupBy("g").agg(F.sum(scaled)).collect())  # at most BUCKETS + 1 rows
        rate = 2.0 / n
        moved = [w - rate * gradient.get(i, 0.0) - 2.0 * L2 * w for i, w in enumerate(ahead)]
        moved_intercept = ahead_intercept - rate * gradient.get(-1, 0.0)
        following = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        push = (pace - 1) / following
        ahead = [m + push * (m - w) for m, w in zip(moved, weights, strict=True)]
        ahead_intercept = moved_intercept + push * (moved_intercept - intercept)
        weights, intercept, pace = moved, moved_intercept, following
    return UrlModel(weights, intercept)


def judge(pages: DataFrame, rules: list[Rule], model: UrlModel) -> DataFrame:
    """The verdict on every row of ``pages`` (page_id, url).

    Returns page_id, host, path, rule, verdict and block_odds (log-odds of the model). A null url has
    an empty host and path. Repeated rows are judged one by one; further columns are ignored.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parts = parts.select(
        "*", rule.alias("rule"), verdict.alias("ruled"), margin(features(F.col("host"), F.col("path")), model).alias("block_odds")
    )
    verdict = F.coalesce("ruled", F.when(F.col("block_odds") >= 0, "block").otherwise("allow"))
    return parts.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_odds")


def ruled_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Labelled URLs (url, block): those on which the rules decide."""
    _, verdict = rule_of(*url_parts(F.col("url")), rules)
    return pages.select("url", (verdict == "block").alias("block")).where("block IS NOT NULL")
