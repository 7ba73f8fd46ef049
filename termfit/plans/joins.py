"""Joins of a large table with a keyed table, chosen by size and safe for hot keys.

A keyed table goes to every executor only when its measured size is below
``BROADCAST_BYTES``. Beyond that both sides are shuffled, and a key that holds a large
share of the rows is split: its rows get a salt, and the other side's row is copied once
per salt. The list of split keys is bounded by construction (a key is on it only when
it holds more than a fair share of all rows: one of as many shares as there are shuffle
partitions, or of ``SHARES`` if these are more), so that list may always be broadcast.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfit.session import durable

BROADCAST_BYTES = 64 * 1024 * 1024
SHARES = 1000


def _width(table: DataFrame) -> Column:
    """Rough in-memory size of a row."""
    widths = [F.lit(32 + 16 * len(table.columns))]
    for name, kind in table.dtypes:
        if kind in ("string", "binary"):
            widths.append(F.coalesce(F.octet_length(name), F.lit(0)))
        elif kind == "array<double>":
            widths.append(F.coalesce(8 * F.array_size(name), F.lit(0)))
    return reduce(add, widths).cast("bigint")


def measured_bytes(table: DataFrame) -> int:
    """Rough in-memory size of a stored or otherwise cheap table, from its rows."""
    return table.agg(F.coalesce(F.sum(_width(table)), F.lit(0))).first()[0]


def fits_broadcast(size: int) -> bool:
    return size <= BROADCAST_BYTES


def shares(df: DataFrame) -> int:
    """Into how many fair shares rows are thought to be divided; grows with the session's partitions."""
    return max(SHARES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(counts: DataFrame, key: str) -> DataFrame:
    """(key, splits) for the keys with more than a fair share of all rows.

    ``counts`` is (key, count), already aggregated.
    """
    total = counts.agg(F.sum("count")).scalar()
    share = F.greatest(total / F.lit(shares(counts)), F.lit(1.0))
    return counts.where(F.col("count") > share).select(
        key, F.ceil(F.col("count") / share).cast("int").alias("splits")
    )


def add_salt(df: DataFrame, key: str, hot: DataFrame, salt: str, *, by: list[str]) -> DataFrame:
    """Number the rows of hot keys by a hash of ``by``; all others get salt 0.

    Rows without a key match nothing, so they are always spread.
    """
    splits = F.broadcast(hot.withColumnRenamed("splits", "_splits"))
    default = F.when(F.col(key).isNull(), F.lit(shares(df))).otherwise(F.lit(1))
    spread = F.pmod(F.xxhash64(*by), F.coalesce("_splits", default))
    return df.join(splits, key, "left").withColumn(salt, spread.cast("int")).drop("_splits")


def copy_per_salt(df: DataFrame, key: str, hot: DataFrame, salt: str) -> DataFrame:
    """Repeat the rows of hot keys once per salt value."""
    splits = F.broadcast(hot.withColumnRenamed("splits", "_splits"))
    numbers = F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1)
    return df.join(splits, key, "left").withColumn(salt, F.explode(numbers)).drop("_splits")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    hot_left: DataFrame,
    left_by: list[str],
    hot_right: DataFrame | None = None,
    right_by: list[str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Equi-join in which hot keys of either side are spread over many tasks.

    ``how="left"`` needs a right side without hot keys, because a copied left row
    would be reported once per copy.
    """
    if hot_right is not None and how != "inner":
        raise ValueError("only inner joins may split both sides")
    left = add_salt(left, key, hot_left, "_salt", by=left_by)
    right = copy_per_salt(right, key, hot_left, "_salt")
    on = [key, "_salt"]
    if hot_right is not None:
        right = add_salt(right, key, hot_right, "_salt2", by=right_by)
        left = copy_per_salt(left, key, hot_right, "_salt2")
        on.append("_salt2")
    return left.join(right, on, how).drop("_salt", "_salt2")


def lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    *,
    by: list[str],
    how: str = "inner",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``facts`` with a stored table that has one row per key.

    The table is measured first. Beyond the broadcast limit, hot keys of ``facts`` are
    found (from ``counts``, if the caller has them) and their rows spread by ``by``.
    """
    if fits_broadcast(measured_bytes(table)):
        return facts.join(F.broadcast(table), key, how)
    if counts is None:
        counts = facts.where(F.col(key).isNotNull()).groupBy(key).count()
    hot = durable(hot_keys(counts, key))
    return salted_join(facts, table, key, hot_left=hot, left_by=by, how=how)


def lookup_frequent(facts: DataFrame, table: DataFrame, key: str, count: str, *, by: list[str]) -> DataFrame:
    """``lookup`` for stored facts and a table that tells in ``count`` how many of their rows hold a key; that column is dropped.

    The most frequent keys that fit a broadcast together meet their rows in place, and only the rows of the other keys are shuffled.
    The facts are read twice for that.
    """
    values = table.drop(count)
    # four classes to an octave; up to 11 rows each hold one number
    classes = table.groupBy(F.floor(4 * F.log2(count)).alias("_class")).agg(F.min(count).alias("least"), F.sum(_width(values)).alias("bytes"))
    least, size = None, 0
    for row in sorted(classes.where("_class IS NOT NULL").collect(), key=lambda r: -r["least"]):
        size += row["bytes"]
        if not fits_broadcast(size):
            break
        least = row["least"]
    else:
        return lookup(facts, values, key, by=by)
    if least is None:
        return lookup(facts, values, key, by=by, counts=table.select(key, F.col(count).alias("count")))
    frequent = table.where(F.col(count) >= least).drop(count)
    others = table.where(F.col(count) < least)
    hot = durable(hot_keys(others.select(key, F.col(count).alias("count")), key))
    left = facts.where(F.col(key).isNotNull()).join(F.broadcast(frequent.select(key)), key, "left_anti")
    return facts.join(F.broadcast(frequent), key).unionByName(salted_join(left, others.drop(count), key, hot_left=hot, left_by=by))
