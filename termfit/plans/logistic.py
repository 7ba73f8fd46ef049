"""Training loop for sparse logistic regression.

While the coefficients fit every task, points stay whole and an iteration reads them once: the reading that
prices the trial steps also sums the gradient at the step that is most likely to pass, the one that passed
before. Only where another step passes, the gradient takes a reading of its own.

With more coefficients the entries lie in the cells of a grid and never move. Coefficients and weights travel to the
cells that list them, and each point's margin is carried from iteration to iteration (m - t q after a
step t). Every REFRESH iterations margins are computed anew, which bounds rounding errors and lineage.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termfit.functions.logistic import gradient_weight, logistic_loss
from termfit.operators.points import (
    BATCH,
    LineSearch,
    Sufficient,
    backtrack_signed,
    confusion_of,
    gradient_parts,
    metrics_of,
    predict,
)
from termfit.operators.rows import row_margins, row_pulls
from termfit.plans.grid import LEFT, RIGHT, PairGrid, blocks_for
from termfit.plans.joins import fits_broadcast, measured_bytes
from termfit.plans.point_cells import side_sums
from termfit.session import Generations, durable

REFRESH = 10
HISTORY = (
    "k INT, time_s DOUBLE, loss DOUBLE, grad_norm DOUBLE, trials INT, gamma DOUBLE, "
    "acc DOUBLE, pre DOUBLE, rec DOUBLE"
)


@dataclass
class LogisticModel:
    """Coefficients as a (feature, coef) table, and how training ended."""

    beta: DataFrame
    grad_norm: float | None = None
    iterations: int | None = None
    converged: bool | None = None
    history: DataFrame | None = None

    def predict(self, points: DataFrame) -> DataFrame:
        """(row_id, y, m, y_hat)"""
        return predict(points, self.beta)

    def save(self, path: str) -> None:
        self.beta.write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LogisticModel:
        return LogisticModel(spark.read.parquet(path))


class _InRows:
    """Points that stay whole, for coefficients that fit every task.

    Their size is checked once, when the first gradient has shown all features. From then on coefficients and gradient are
    arrays on the driver, which hands them to the tasks and gets one sum per feature back.
    """

    def __init__(self, points: DataFrame, num_partitions: int | None):
        points = points.select("row_id", "y", "x")
        self.points = (points.repartition(num_partitions) if num_partitions else points).persist(StorageLevel.MEMORY_AND_DISK)
        self.features = pa.array([], pa.string())
        self.coef = self.g = self.loss = None

    def begin(self, beta: DataFrame, lam: float) -> bool:
        """Start at ``beta``; False if the features turn out not to fit every task."""
        parts = durable(gradient_parts(row_pulls(self.points, beta), beta, lam))
        size = parts.agg(F.count("feature"), F.coalesce(F.sum(F.octet_length("feature")), F.lit(0))).first()
        if not fits_broadcast(size[0] * 96 + size[1]):
            return False
        parts = parts.toArrow()
        self.loss = pc.sum(parts.column("loss")).as_py() or 0.0
        parts = parts.filter(parts.column("feature").is_valid())
        self.features = parts.column("feature").combine_chunks()
        self.coef, self.g = (parts.column(c).to_numpy() for c in ("coef", "g"))
        return True

    def _table(self) -> pa.Table:
        columns = {"feature": self.features, "coef": self.coef} | ({} if self.g is None else {"g": self.g})
        return pa.table(columns)

    def _read(self, t: float, steps: list[float]) -> tuple[np.ndarray, list[float]]:
        """One reading of the points: the pull per feature and the loss at coef - t g, then the losses at ``steps``."""
        sums = row_pulls(self.points, self._table(), t, steps).groupBy("feature", "step")
        sums = sums.agg(F.sum("pull").alias("pull"), F.sum("loss").alias("loss")).toArrow()
        known = sums.filter(sums.column("feature").is_valid())
        pulls = np.zeros(len(self.features))
        pulls[pc.index_in(known.column("feature").combine_chunks(), value_set=self.features).to_numpy()] = known.column("pull").to_numpy()
        losses = sums.filter(sums.column("feature").is_null()).sort_by("step").column("loss").to_pylist()
        return pulls, losses or [0.0] * (1 + len(steps))

    def sums(self, lam: float) -> tuple[float, float, float, float]:
        """(loss without penalty, |coef|^2, <coef, g>, |g|^2)"""
        if self.g is None:
            pulls, (self.loss,) = self._read(0.0, [])
            self.g = pulls + 2.0 * lam * self.coef
        return self.loss, float(self.coef @ self.coef), float(self.coef @ self.g), float(self.g @ self.g)

    def search(self, test: Sufficient, guess: int, width: int) -> LineSearch:
        """Move to the first passing step. If it is the one that was guessed, the gradient there is known as well."""
        start, ahead = 0, None
        at = test.b**guess
        while True:
            steps = test.steps(start, width)
            pulls, losses = self._read(at, steps)
            ahead = ahead or (pulls, losses[0])
            n = test.first_passing(steps, losses[1:])
            if n is not None:
                break
            start += width
        found = LineSearch(start + n, steps[n], start // width + 1)
        self.coef, self.g = self.coef - found.t * self.g, None
        if found.n == guess:
            self.g, self.loss = ahead[0] + 2.0 * test.lam * self.coef, ahead[1]
        return found

    def margins(self, of: _InRows) -> DataFrame:
        return row_margins(self.points, of._table(), m="coef")

    def beta(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(pa.table({"feature": self.features, "coef": self.coef}))

    def release(self) -> None:
        self.points.unpersist()


class _InCells:
    """Entries that lie in the cells of a grid, and the margins of the points, for more coefficients than fit a task."""

    def __init__(self, points: DataFrame, num_partitions: int | None):
        spark = points.sparkSession
        slots = num_partitions or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        labels = points.select("row_id", "y").repartition(slots, "row_id").sortWithinPartitions("row_id")
        self.labels = labels.persist(StorageLevel.MEMORY_AND_DISK)
        rows = self.labels.count()
        if self.labels.where("row_id IS NOT NULL").select("row_id").distinct().count() < rows:
            self.labels.unpersist()
            raise ValueError("row_id does not name every point")
        pairs = points.select("row_id", F.explode("x").alias("feature", "value")).select("row_id", "feature", F.expr("coalesce(value, 0D)").alias("value"))
        n, features, size = pairs.agg(F.count("*"), F.approx_count_distinct("feature"), F.avg(F.octet_length("feature"))).first()
        blocks = blocks_for(n, rows * 48, int(features * (96 + (size or 0))), slots)
        self.grid = PairGrid(pairs, "row_id", "feature", {"value": "double"}, blocks, slots)
        self.row_kind = points.schema["row_id"].dataType.simpleString()
        self.kept: list[DataFrame] = []
        self.rows: DataFrame | None = None  # (row_id, y, m)
        self.parts: DataFrame | None = None  # (feature, step, coef, g, loss)
        self.coefficients: DataFrame | None = None
        self.age = 0

    def _sent(self, side: int, rows: DataFrame, key: str, value: str) -> DataFrame:
        return self.grid.send(side, rows.select(F.col(key).alias("id"), F.array(value).alias("vector")))

    def along(self, table: DataFrame, column: str, name: str) -> DataFrame:
        """(row_id, name): the sum of value * column per point with features; only partial sums leave a cell."""
        sent = self._sent(RIGHT, table.where("feature IS NOT NULL"), "feature", column)
        parts = self.grid.apply(side_sums(LEFT), f"id {self.row_kind}, part double", sent)
        return parts.groupBy(F.col("id").alias("row_id")).agg(F.sum("part").alias(name))

    def _new_margins(self, beta: DataFrame) -> DataFrame:
        found = self.labels.join(self.along(beta, "coef", "m"), "row_id", "left")
        return found.select("row_id", "y", F.coalesce("m", F.lit(0.0)).alias("m"))

    def _keep(self, rows: DataFrame) -> DataFrame:
        """Cached rows; those before them go, as soon as these are there."""
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        rows.count()
        for table in self.kept:
            table.unpersist()
        self.kept = [rows]
        return rows

    def begin(self, beta: DataFrame, lam: float) -> bool:
        self.coefficients, self.rows, self.parts = beta, None, None
        return True

    def _gradient(self, lam: float) -> DataFrame:
        if self.rows is None or self.age >= REFRESH:
            self.rows, self.age = self._keep(self._new_margins(self.coefficients)), 0
        labelled = self.rows.where("y IS NOT NULL")
        sent = self._sent(LEFT, labelled.select("row_id", gradient_weight().alias("w")), "row_id", "w")
        pulls = self.grid.apply(side_sums(RIGHT), "id string, part double", sent)
        pulls = pulls.select(F.col("id").alias("feature"), F.lit(-1).alias("step"), F.col("part").alias("pull"), F.lit(0.0).alias("loss"))
        losses = labelled.agg(F.sum(logistic_loss()).alias("loss"))
        losses = losses.select(F.lit(None).cast("string").alias("feature"), F.lit(-1).alias("step"), F.lit(0.0).alias("pull"), "loss")
        return durable(gradient_parts(pulls.unionByName(losses), self.coefficients, lam))

    def sums(self, lam: float) -> tuple[float, float, float, float]:
        """(loss without penalty, |coef|^2, <coef, g>, |g|^2)"""
        if self.parts is None:
            self.parts = self._gradient(lam)
        whole = self.parts.agg(
            F.expr("coalesce(sum(loss), 0D)"), *[F.expr(f"coalesce(sum({p}) FILTER (WHERE feature IS NOT NULL), 0D)") for p in ("coef * coef", "coef * g", "g * g")]
        )
        return tuple(whole.first())

    def search(self, test: Sufficient, guess: int, width: int) -> LineSearch:
        """Move to the first passing step; every margin moves along."""
        moving = self.parts.where("feature IS NOT NULL")
        along = self.rows.join(self.along(moving, "g", "q"), "row_id", "left")
        trial = self._keep(along.select("row_id", "y", "m", F.coalesce("q", F.lit(0.0)).alias("q")))
        signed = trial.select(F.expr("y * m").alias("p"), F.expr("y * q").alias("s"))
        found = backtrack_signed(signed, *test, width=width)
        self.rows = trial.select("row_id", "y", F.expr(f"m - {found.t!r}D * q").alias("m"))
        self.coefficients = moving.select("feature", F.expr(f"coef - {found.t!r}D * g").alias("coef"))
        self.parts = None
        self.age += 1
        return found

    def margins(self, of: _InCells) -> DataFrame:
        return self._new_margins(of.coefficients)

    def beta(self, spark: SparkSession) -> DataFrame:
        return self.coefficients

    def release(self) -> None:
        self.grid.release()
        for table in (self.labels, *self.kept):
            table.unpersist()


def train_logistic(
    points: DataFrame,
    lam: float = 0.0,
    max_iter: int = 100,
    eps: float = 0.1,
    beta0: DataFrame | None = None,
    test: DataFrame | None = None,
    num_partitions: int | None = None,
    state: str | None = None,
) -> LogisticModel:
    """Gradient descent with backtracking while k < max_iter and |gradient| > eps.

    Coefficients and gradient stay tables; while they fit every task they are handed to the tasks, and beyond
    that ``row_id`` has to name every point. Losses, norms and step sizes are the only other values on the driver.
    With a shared folder ``state`` every iteration leaves a generation there, and a later run over the same points with the same
    settings goes on behind the last one.
    """
    spark = points.sparkSession
    saved = resumed = None
    if state is not None:
        saved = Generations(spark, state, {"lam": lam, "points": points.count()})
        resumed = saved.newest()
    if resumed:
        beta = resumed[0]
        small = fits_broadcast(measured_bytes(beta))
    elif beta0 is None:
        beta = spark.createDataFrame([], "feature string, coef double")
        small = True
    else:
        beta = durable(beta0.select("feature", "coef"))
        small = fits_broadcast(measured_bytes(beta))
    tables = [points] if test is None else [points, test]
    layouts = [(_InRows if small else _InCells)(table, num_partitions) for table in tables]

    start = time.time()
    rows = []
    norm = 2 * eps
    width = BATCH
    k = guess = 0
    if resumed:
        k, norm, guess, width, rows = (resumed[1][name] for name in ("k", "norm", "guess", "width", "rows"))
    try:
        if k < max_iter and norm > eps and not layouts[0].begin(beta, lam):
            for place, table in enumerate(tables):
                layouts[place].release()
                layouts[place] = _InCells(table, num_partitions)
            layouts[0].begin(beta, lam)
        while k < max_iter and norm > eps:
            loss, coef_sq, coef_g, grad_sq = layouts[0].sums(lam)
            loss, norm = loss + lam * coef_sq, math.sqrt(grad_sq)
            found = layouts[0].search(Sufficient(loss, coef_sq, coef_g, grad_sq, lam), guess, width)
            # the next search most likely needs about as many trials
            guess, width = found.n, BATCH * (1 + (found.n + 2) // BATCH)
            beta = layouts[0].beta(spark)
            quality = [None, None, None]
            if test is not None:
                quality = list(metrics_of(confusion_of(layouts[1].margins(layouts[0]))).first())
            rows.append([k, time.time() - start, loss, norm, found.n, found.t, *quality])
            k += 1
            if saved:
                beta = saved.save(k, beta, {"k": k, "norm": norm, "guess": guess, "width": width, "rows": rows})
    finally:
        for layout in layouts:
            layout.release()
    return LogisticModel(beta, norm, k, norm <= eps, spark.createDataFrame(rows, HISTORY))
