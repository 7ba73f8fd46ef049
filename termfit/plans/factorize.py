"""Training loops for matrix factorization."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termfit.operators.factors import (
    ITEM,
    USER,
    as_items,
    as_users,
    gain_schedule,
    random_vector,
    report,
    step_models,
)
from termfit.plans.joins import add_salt, copy_per_salt, fits_broadcast, hot_keys
from termfit.plans.rating_cells import RatingGrid
from termfit.session import Generations, durable

ROW = ["user_id", "item_id", "rating", "fold"]
HISTORY = (
    "iter INT, time_s DOUBLE, objective DOUBLE, change DOUBLE, gamma DOUBLE, "
    "rmse DOUBLE, rmse_scored DOUBLE, n BIGINT, n_scored BIGINT"
)


@dataclass
class FactorModel:
    """User and item profiles as (id, factors) tables, and one history row per iteration.

    The history shows each iteration's profiles before their update.
    """

    users: DataFrame
    items: DataFrame
    history: DataFrame | None = None

    def save(self, path: str) -> None:
        self.users.write.parquet(f"{path}_U")
        self.items.write.parquet(f"{path}_V")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FactorModel:
        return FactorModel(spark.read.parquet(f"{path}_U"), spark.read.parquet(f"{path}_V"))


class _Ratings:
    """Fold-tagged ratings laid out once for the many passes of a training run, with at most one large side.

    While the profiles of a side fit a broadcast, ratings stay where they are. For a
    larger side equal rows are merged into one with a weight, hot ids are
    split by salts, and the table is kept partitioned and sorted by that side, so that an
    iteration moves its profiles and not the ratings. Two large sides need a ``RatingGrid``.
    """

    def __init__(self, ratings: DataFrame, small_users: bool, small_items: bool, partitions: int | None):
        self.large = "item_id" if small_users else "user_id"
        self.broadcast_only = small_users and small_items
        if self.broadcast_only:
            table = ratings.repartition(partitions) if partitions else ratings
            self.table = table.persist(StorageLevel.MEMORY_AND_DISK)
            return
        merged = ratings.groupBy(*ROW).agg(F.count(F.lit(1)).alias("weight"))
        merged = merged.persist(StorageLevel.MEMORY_AND_DISK)
        self.hot = durable(hot_keys(merged.groupBy(self.large).count(), self.large))
        layout = [self.large, "_salt"]
        table = add_salt(merged, self.large, self.hot, "_salt", by=ROW)
        table = table.repartition(*([partitions] if partitions else []), *layout)
        self.table = table.sortWithinPartitions(*layout).persist(StorageLevel.MEMORY_AND_DISK)
        # plans know the partitioning and order of a cached table once it is filled
        self.table.count()
        merged.unpersist()

    def with_profiles(self, profiles: DataFrame) -> DataFrame:
        users = profiles.where(F.col("side") == USER)
        items = profiles.where(F.col("side") == ITEM)
        table = self.table
        # the large side first, in the layout; held-out rows may lack a profile, so no row is dropped here
        for key, side in sorted({"user_id": as_users(users), "item_id": as_items(items)}.items(), key=lambda s: s[0] != self.large):
            if key == self.large and not self.broadcast_only:
                table = table.join(copy_per_salt(side, key, self.hot, "_salt"), [key, "_salt"], "left")
            else:
                table = table.join(F.broadcast(side), key, "left")
        return table

    def step(self, profiles: DataFrame, models: list[int], gammas: list[float], lam: float, mu: float, d: int) -> DataFrame:
        # with everything broadcast there is little to exchange
        own = None if self.broadcast_only else profiles
        return step_models(self.with_profiles(profiles), models, gammas, lam, mu, d, own)

    def release(self) -> None:
        self.table.unpersist()


def _draw(rows: DataFrame, models: list[int], d: int, seed: int, dist: str) -> DataFrame:
    """(side, id, factors): random profiles, NULL for a model that an id does not train.

    All models start from the same vector of an id.
    """
    nothing = f"array_repeat(CAST(NULL AS DOUBLE), {d})"
    parts = ", ".join(f"IF(low = {m} AND high = {m}, {nothing}, drawn)" for m in models)
    tables = []
    for side, key, tag in ((USER, "user_id", "u"), (ITEM, "item_id", "v")):
        ids = rows.groupBy(F.col(key).alias("id")).agg(
            F.min("fold").alias("low"), F.max("fold").alias("high")
        )
        drawn = ids.withColumn("drawn", random_vector(d, seed, tag, dist))
        tables.append(drawn.select(F.lit(side).alias("side"), "id", F.expr(f"concat({parts})").alias("factors")))
    return tables[0].unionByName(tables[1])


def _descend_all(
    rows: DataFrame,
    models: list[int],
    d: int,
    gain: float,
    power: float,
    lam: float,
    mu: float,
    eps: float,
    maxiter: int,
    seed: int,
    dist: str,
    num_partitions: int | None,
    initial: DataFrame | None = None,
    state: str | None = None,
) -> tuple[DataFrame, list[list]]:
    """Train several models side by side on (user_id, item_id, rating, fold) rows.

    A model trains on the rows outside its fold and is tested on its fold; a model
    without rows in its fold is tested on its training rows. Returns the profiles and
    one history row per model and iteration, the model's place first.
    """
    rows = rows.select(*ROW).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}
    n_test = [sizes.get(m, 0) for m in models]
    n_train = [sum(sizes.values()) - n for n in n_test]
    saved = resumed = None
    if state is not None:
        settings = {"models": models, "d": d, "gain": gain, "power": power, "lam": lam, "mu": mu, "seed": seed, "dist": dist}
        saved = Generations(rows.sparkSession, state, settings | {"train": n_train, "test": n_test})
        resumed = saved.newest()
    if resumed:
        profiles = resumed[0]
    else:
        profiles = durable(_draw(rows, models, d, seed, dist) if initial is None else initial)
    counts = profiles.agg(F.count_if(F.col("side") == USER), F.count_if(F.col("side") == ITEM)).first()
    small = [fits_broadcast(n * (64 + 8 * d * len(models))) for n in counts]
    if any(small):
        ratings = _Ratings(rows, *small, num_partitions)
    else:
        ratings = RatingGrid(rows, list(counts), d * len(models), num_partitions)
    if getattr(ratings, "table", None) is not rows:
        rows.unpersist()

    start = time.time()
    history = []
    totals = [1e99] * len(models)
    changes = [1e99] * len(models)
    iteration = 0
    if resumed:
        iteration, history, totals, changes = (resumed[1][name] for name in ("iteration", "history", "totals", "changes"))
    try:
        while iteration < maxiter and any(change > eps for change in changes):
            iteration += 1
            gamma = gain_schedule(gain, power, iteration)
            # a model that has stopped stays where it is
            active = [change > eps for change in changes]
            gammas = [gamma if on else 0.0 for on in active]
            profiles = durable(ratings.step(profiles, models, gammas, lam, mu, d))
            # one row per model
            sums = {row["place"]: row for row in report(profiles, d).collect()}
            for i, on in enumerate(active):
                if i not in sums:
                    changes[i] = math.nan
                if not on or i not in sums:
                    continue
                _, error, users_norm, items_norm, held_error, held_rows, train_rows = sums[i]
                previous, totals[i] = totals[i], error + lam * users_norm + mu * items_norm
                changes[i] = abs(totals[i] - previous)
                n, scored = (n_test[i], held_rows) if n_test[i] else (n_train[i], train_rows)
                if not n_test[i]:
                    held_error = error
                quality = [math.sqrt(held_error / count) if count else None for count in (n, scored)]
                seconds = time.time() - start
                history.append([i, iteration, seconds, totals[i], changes[i], gamma, *quality, n, scored])
            if saved:
                record = {"iteration": iteration, "history": history, "totals": totals, "changes": changes}
                profiles = saved.save(iteration, profiles, record)
    finally:
        ratings.release()
    return profiles, history


def factorize(
    ratings: DataFrame,
    test: DataFrame | None = None,
    d: int = 10,
    gain: float = 0.001,
    power: float = 0.2,
    lam: float = 1.0,
    mu: float = 1.0,
    eps: float = 1e-99,
    maxiter: int = 20,
    seed: int = 1234567,
    dist: str = "normal",
    num_partitions: int | None = None,
    initial: FactorModel | None = None,
    state: str | None = None,
) -> FactorModel:
    """Full-batch gradient descent on both profile tables at once.

    Without ``test`` the reported error is the training error, and ``n_scored`` counts the ratings
    whose user and item both have a profile. Profiles of ``initial`` without a rating are not in the
    model, because a step only moves what ratings pull at. Only sums reach the
    driver; each iteration ends in a checkpoint of the new profiles. With a shared folder ``state`` it also leaves a generation
    there, and a later run with the same settings and ratings goes on behind the last one.
    """
    columns = ["user_id", "item_id", "rating"]
    rows = ratings.select(*columns, F.lit(-1).alias("fold"))
    if test is not None:
        rows = rows.unionByName(test.select(*columns, F.lit(0).alias("fold")))
    given = None
    if initial is not None:
        given = initial.users.select(F.lit(USER).alias("side"), "id", "factors").unionByName(
            initial.items.select(F.lit(ITEM).alias("side"), "id", "factors")
        )
    profiles, history = _descend_all(
        rows, [0], d, gain, power, lam, mu, eps, maxiter, seed, dist, num_partitions, given, state
    )
    trained = profiles.where(F.get("factors", F.lit(0)).isNotNull())
    return FactorModel(
        trained.where(F.col("side") == USER).select("id", "factors"),
        trained.where(F.col("side") == ITEM).select("id", "factors"),
        ratings.sparkSession.createDataFrame([row[1:] for row in history], HISTORY),
    )


def cross_validate(
    folded: DataFrame,
    folds: int,
    d: int = 10,
    gain: float = 0.001,
    power: float = 0.2,
    lam: float = 1.0,
    mu: float = 1.0,
    eps: float = 1e-99,
    maxiter: int = 20,
    seed: int = 1234567,
    dist: str = "normal",
    num_partitions: int | None = None,
    state: str | None = None,
) -> DataFrame:
    """(fold, n_train, n_test, iterations, rmse, rmse_scored): one row per fold.

    Each fold is held out once and its last logged errors are kept; a single fold is
    both training and test set. ``cross_validation_error`` gives the mean.

    The models of all folds are trained side by side, so the ratings are read once per
    iteration and not once per fold and iteration. A fold number outside 0 ... folds - 1, or none, is an error.
    ``state`` is a folder to go on from, as in ``factorize``.
    """
    spark = folded.sparkSession
    folded = folded.select(*ROW).persist(StorageLevel.MEMORY_AND_DISK)
    known = F.when(F.col("fold").between(0, folds - 1), F.col("fold"))
    sizes = {r["known"]: r["count"] for r in folded.groupBy(known.alias("known")).count().collect()}
    if None in sizes:
        folded.unpersist()
        raise ValueError(f"{sizes[None]} rows have no fold from 0 to {folds - 1}")
    # the only fold of a single-fold run is not held out
    table = folded.withColumn("fold", F.lit(-1)) if folds == 1 else folded
    models = list(range(folds))
    _, history = _descend_all(
        table, models, d, gain, power, lam, mu, eps, maxiter, seed, dist, num_partitions, None, state
    )
    last = {row[0]: row for row in history}
    rows = []
    for m in models:
        n_test = sizes.get(m, 0)
        n_train = sum(sizes.values()) - (n_test if folds > 1 else 0)
        _, iterations, _, _, _, _, rmse, rmse_scored, _, _ = last.get(m, [m, 0] + [None] * 8)
        rows.append((m, n_train, n_test, iterations, rmse, rmse_scored))
    folded.unpersist()
    schema = "fold INT, n_train BIGINT, n_test BIGINT, iterations INT, rmse DOUBLE, rmse_scored DOUBLE"
    return spark.createDataFrame(rows, schema)


def cross_validation_error(folds: DataFrame) -> DataFrame:
    """(folds, rmse, rmse_scored): the means over the rows of ``cross_validate``; folds without an error are not in them."""
    return folds.agg(F.count("*").alias("folds"), F.avg("rmse").alias("rmse"), F.avg("rmse_scored").alias("rmse_scored"))


def fit_and_save(ratings: DataFrame, path: str, **options) -> FactorModel:
    """Train on everything and store both profile tables below ``path``."""
    model = factorize(ratings, **options)
    model.save(path)
    return model
