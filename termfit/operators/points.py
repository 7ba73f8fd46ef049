"""Logistic regression on sparse labelled points, one step at a time.

Points are (row_id, y in {-1, +1}, x MAP<STRING, DOUBLE>) with one row per ``row_id``;
coefficients are (feature, coef) and a feature without a coefficient has coefficient 0.
The objective is sum(log(1 + exp(-y <coef, x>))) + lam * |coef|^2: a sum, not a mean,
without intercept or scaling.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termfit.functions.logistic import gradient_weight, logistic_loss, softplus_sql
from termfit.operators.rows import row_margins, row_pulls
from termfit.plans.joins import fits_broadcast, lookup, measured_bytes
from termfit.session import durable


def entries(points: DataFrame) -> DataFrame:
    """(row_id, y, feature, value, head): one row per feature of a point.

    ``head`` marks one entry per point; a point without features keeps one empty entry.
    """
    exploded = points.select("row_id", "y", F.posexplode_outer("x").alias("_pos", "feature", "value"))
    return exploded.select(
        "row_id", "y", "feature", "value", F.expr("coalesce(_pos, 0) = 0").alias("head")
    )


def all_features(points: DataFrame) -> DataFrame:
    """(feature): the distinct features of all points."""
    return points.select(F.explode(F.map_keys("x")).alias("feature")).distinct()


def axpy(a: DataFrame, c: float, b: DataFrame) -> DataFrame:
    """(feature, coef) of a + c * b over the union of their features."""
    scaled = b.select("feature", (F.lit(float(c)) * F.col("coef")).alias("coef"))
    stacked = a.select("feature", "coef").unionByName(scaled)
    return stacked.groupBy("feature").agg(F.sum("coef").alias("coef"))


def with_coefficients(points: DataFrame, beta: DataFrame) -> DataFrame:
    """The entries of the points with the coefficient of their feature, where it has one.

    The coefficient table is measured to choose the join, so pass a stored one.
    """
    return lookup(entries(points), beta.select("feature", "coef"), "feature", by=["row_id"], how="left")


def row_sums(scored: DataFrame, **columns: str) -> DataFrame:
    """(row_id, y, name...): for each ``name=column`` the sum of value * column per point."""
    sums = [F.expr(f"coalesce(sum(value * {c}), 0D)").alias(name) for name, c in columns.items()]
    return scored.groupBy("row_id", "y").agg(*sums)


def sums_of_points(points: DataFrame, table: DataFrame, **columns: str) -> DataFrame:
    """(row_id, y, name...): ``row_sums`` against a stored (feature, ...) table, which is measured.

    A table that fits every task is looked up inside the row. Otherwise the entries travel to a salted join, and the
    sums are formed per ``row_id``.
    """
    if fits_broadcast(measured_bytes(table)):
        return row_margins(points, table, **columns)
    scored = lookup(entries(points), table.select("feature", *columns.values()), "feature", by=["row_id"], how="left")
    return row_sums(scored, **columns)


def margins(points: DataFrame, beta: DataFrame) -> DataFrame:
    """(row_id, y, m) with m = <coef, x>."""
    return sums_of_points(points, beta, m="coef")


def total_loss(points: DataFrame, beta: DataFrame, lam: float = 0.0) -> DataFrame:
    """(loss): the regularised total loss."""
    fit = margins(points, beta).agg(F.sum(logistic_loss()).alias("part"))
    penalty = beta.agg((F.lit(float(lam)) * F.sum(F.col("coef") * F.col("coef"))).alias("part"))
    return fit.unionByName(penalty).agg(F.coalesce(F.sum("part"), F.lit(0.0)).alias("loss"))


def gradient_parts(pulls: DataFrame, beta: DataFrame, lam: float) -> DataFrame:
    """(feature, step, coef, g, loss): gradient and losses from the partial sums of ``row_pulls``.

    The coefficients travel along as rows, so a single aggregation by feature (with partial sums before its
    shuffle) yields everything. Rows without a feature hold the losses.
    """
    carried = beta.select("feature", F.lit(-1).alias("step"), "coef", F.lit(0.0).alias("pull"), F.lit(0.0).alias("loss"))
    summed = (
        pulls.withColumn("coef", F.lit(0.0))
        .unionByName(carried)
        .groupBy("feature", "step")
        .agg(*[F.expr(f"coalesce(sum({name}), 0D)").alias(name) for name in ("coef", "pull", "loss")])
    )
    return summed.select("feature", "step", "coef", F.expr(f"pull + 2D * {float(lam)!r}D * coef").alias("g"), "loss")


def _joined_pulls(points: DataFrame, beta: DataFrame) -> DataFrame:
    """``row_pulls`` where the coefficients do not fit every task: the margin is a window sum over a point's entries."""
    scored = with_coefficients(points, beta)
    margin = F.coalesce(F.sum(F.col("value") * F.col("coef")).over(Window.partitionBy("row_id")), F.lit(0.0))
    weighted = scored.select("feature", "value", "head", "y", margin.alias("m"))
    pull = F.coalesce(gradient_weight() * F.col("value"), F.lit(0.0))
    # the loss is booked on each point's head entry
    loss = F.when(F.col("head"), logistic_loss()).otherwise(0.0)
    return weighted.select("feature", F.lit(-1).alias("step"), pull.alias("pull"), loss.alias("loss"))


def total_gradient(points: DataFrame, beta: DataFrame, lam: float = 0.0) -> DataFrame:
    """(feature, g): the gradient of the regularised total loss.

    The coefficient table is measured to choose the plan, so pass a stored one. While it fits every task, points stay whole and only
    sums per feature are exchanged.
    """
    small = fits_broadcast(measured_bytes(beta))
    parts = gradient_parts(row_pulls(points, beta) if small else _joined_pulls(points, beta), beta, lam)
    return parts.where(F.col("feature").isNotNull()).select("feature", "g")


def grad_norm(gradient: DataFrame) -> DataFrame:
    """(grad_norm): the Euclidean norm of a gradient."""
    return gradient.agg(F.expr("coalesce(sqrt(sum(g * g)), 0D)").alias("grad_norm"))


class LineSearch(NamedTuple):
    n: int
    t: float
    batches: int


BATCH = 16


def backtrack(
    rows: DataFrame,
    fx: float,
    coef_sq: float,
    coef_g: float,
    grad_sq: float,
    lam: float,
    a: float = 0.2,
    b: float = 0.6,
    width: int = BATCH,
) -> LineSearch:
    """Smallest n with L(coef - t g) <= fx - a t |g|^2 for t = b^n.

    ``rows`` is (y, m, q) with m = <coef, x> and q = <g, x>. A trial only changes a
    margin to m - t q, so one aggregation prices ``width`` step sizes; further batches
    run until one passes (at the latest when t has become 0). The rows are kept for the search, so
    that only the first batch reads their source.
    """
    signed = rows.select(F.expr("y * m").alias("p"), F.expr("y * q").alias("s"))
    signed = signed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return backtrack_signed(signed, fx, coef_sq, coef_g, grad_sq, lam, a, b, width)
    finally:
        signed.unpersist()


def backtrack_signed(
    signed: DataFrame,
    fx: float,
    coef_sq: float,
    coef_g: float,
    grad_sq: float,
    lam: float,
    a: float,
    b: float,
    width: int,
) -> LineSearch:
    """``backtrack`` over stored rows (p, s) with p = y m and s = y q."""
    test = Sufficient(fx, coef_sq, coef_g, grad_sq, lam, a, b)
    start = 0
    while True:
        steps = test.steps(start, width)
        priced = signed.agg(
            *[F.expr(f"sum({softplus_sql(f'p - {t!r}D * s')})").alias(f"l{i}") for i, t in enumerate(steps)]
        )
        n = test.first_passing(steps, priced.first())
        if n is not None:
            return LineSearch(start + n, steps[n], start // width + 1)
        start += width


class Sufficient(NamedTuple):
    """The condition L(coef - t g) <= fx - a t |g|^2 for the steps t = b^n."""

    fx: float
    coef_sq: float
    coef_g: float
    grad_sq: float
    lam: float
    a: float = 0.2
    b: float = 0.6

    def steps(self, start: int, width: int) -> list[float]:
        steps = [self.b**start]
        while len(steps) < width:
            steps.append(steps[-1] * self.b)
        return steps

    def first_passing(self, steps: list[float], losses: list[float]) -> int | None:
        """Place of the first step that passes, given the losses without penalty; a step of 0 always does."""
        for i, (t, loss) in enumerate(zip(steps, losses, strict=True)):
            penalty = self.lam * (self.coef_sq - 2 * t * self.coef_g + t * t * self.grad_sq)
            if not (loss or 0.0) + penalty > self.fx - self.a * t * self.grad_sq or t == 0.0:
                return i
        return None


def line_search(
    points: DataFrame,
    beta: DataFrame,
    gradient: DataFrame,
    fx: float,
    grad_sq: float,
    lam: float = 0.0,
    a: float = 0.2,
    b: float = 0.6,
) -> LineSearch:
    """Backtracking line search from ``beta`` against a (feature, g) gradient."""
    stacked = durable(
        beta.select("feature", "coef", F.lit(0.0).alias("g"))
        .unionByName(gradient.select("feature", F.lit(0.0).alias("coef"), "g"))
        .groupBy("feature")
        .agg(F.sum("coef").alias("coef"), F.sum("g").alias("g"))
    )
    coef_sq, coef_g = stacked.agg(
        F.expr("coalesce(sum(coef * coef), 0D)"), F.expr("coalesce(sum(coef * g), 0D)")
    ).first()
    return backtrack(sums_of_points(points, stacked, m="coef", q="g"), fx, coef_sq, coef_g, grad_sq, lam, a, b)


def predictions(scored_rows: DataFrame) -> DataFrame:
    """(row_id, y, m, y_hat): the class is +1 for a positive margin and -1 otherwise."""
    return scored_rows.withColumn("y_hat", F.expr("IF(m > 0, 1, -1)"))


def predict(points: DataFrame, beta: DataFrame) -> DataFrame:
    return predictions(margins(points, beta))


def confusion_of(scored_rows: DataFrame) -> DataFrame:
    counts = {
        "p": "m > 0",
        "n": "NOT m > 0",
        "tp": "m > 0 AND y = 1",
        "fp": "m > 0 AND y = -1",
        "tn": "NOT m > 0 AND y = -1",
        "fn": "NOT m > 0 AND y = 1",
    }
    return scored_rows.agg(*[F.expr(f"count_if({rule})").alias(name) for name, rule in counts.items()])


def confusion(points: DataFrame, beta: DataFrame) -> DataFrame:
    """(p, n, tp, fp, tn, fn): predicted sizes and confusion counts, in one pass."""
    return confusion_of(margins(points, beta))


def metrics_of(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.expr("try_divide(cast(tp + tn AS double), p + n)").alias("acc"),
        F.expr("try_divide(cast(tp AS double), tp + fp)").alias("pre"),
        F.expr("try_divide(cast(tp AS double), tp + fn)").alias("rec"),
    )


def metrics(points: DataFrame, beta: DataFrame) -> DataFrame:
    """(acc, pre, rec): accuracy, precision and recall; NULL where undefined."""
    return metrics_of(confusion(points, beta))
