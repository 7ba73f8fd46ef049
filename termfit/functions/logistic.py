"""Per-row terms of the logistic loss for labels in {-1, +1}, over SQL references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def softplus_sql(z: str) -> str:
    """log(1 + exp(-z)) in the form that does not overflow."""
    return f"(log1p(exp(-abs({z}))) + greatest(-({z}), 0D))"


def logistic_loss(margin: str = "m", y: str = "y") -> Column:
    """log(1 + exp(-y m))."""
    return F.expr(softplus_sql(f"{y} * {margin}"))


def gradient_weight(margin: str = "m", y: str = "y") -> Column:
    """-y / (1 + exp(y m)): the factor of x in the gradient of the loss."""
    return F.expr(f"-{y} / (1D + exp({y} * {margin}))")
