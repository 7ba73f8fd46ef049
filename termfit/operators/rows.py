"""Margins, gradients and step prices inside the row, while the coefficients fit every task.

A point arrives whole, so its margin is a sum over its own map: nothing is exploded and nothing
is exchanged by point. Batches of points are worked on as arrays; only sums per feature leave a task.
The coefficient table is collected for that, so its size must have been checked (``fits_broadcast``). A table
that is at hand already is given as an Arrow table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The functions below run in Python workers, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Features whose sums a task holds before it passes them on.
HELD_FEATURES = 1_000_000


class _Table:
    """Coefficient columns by feature, 0 for a feature that has none."""

    def __init__(self, table: pa.Table, columns: list[str]):
        self.columns = [pc.fill_null(table.column(c).combine_chunks().cast(pa.float64()), 0.0).to_numpy() for c in columns]
        self.places = {f: i for i, f in enumerate(table.column("feature").to_pylist())}

    def of(self, features: list[str]) -> list[np.ndarray]:
        place = np.array([self.places.get(f, -1) for f in features], np.int64)
        return [np.where(place >= 0, c[place], 0.0) if len(c) else np.zeros(len(place)) for c in self.columns]


class _Points:
    """The entries of a batch of points: row, feature code and value of each."""

    def __init__(self, x: pa.MapArray):
        ends = x.offsets.to_numpy()
        keys, items = (part.slice(ends[0], ends[-1] - ends[0]) for part in (x.keys, x.items))
        self.n = len(x)
        self.row = np.repeat(np.arange(self.n), np.diff(ends))
        coded = keys.dictionary_encode()
        self.features, self.code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self.value = pc.fill_null(items, 0.0).to_numpy(zero_copy_only=False)

    def dot(self, coefficients: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * coefficients[self.code], minlength=self.n).astype(float)

    def pull(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.code, weights=self.value * weight[self.row], minlength=len(self.features)).astype(float)


def _collected(table: DataFrame | pa.Table, columns: list[str]) -> _Table:
    if isinstance(table, DataFrame):
        table = table.where("feature IS NOT NULL").select("feature", *columns).toArrow()
    return _Table(table, columns)


def row_margins(points: DataFrame, table: DataFrame | pa.Table, **sums: str) -> DataFrame:
    """(row_id, y, name...): for each ``name=column`` the sum of value * column of every point, in place."""
    names, held = list(sums), _collected(table, list(sums.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _Points(batch.column("x"))
            found = [rows.dot(c) for c in held.of(rows.features)]
            yield pa.record_batch(
                {"row_id": batch.column("row_id"), "y": batch.column("y")} | {n: pa.array(v) for n, v in zip(names, found, strict=True)}
            )

    kinds = [f"{c} {points.schema[c].dataType.simpleString()}" for c in ("row_id", "y")]
    return points.select("row_id", "y", "x").mapInArrow(run, ", ".join([*kinds, *(f"{n} double" for n in names)]))


def softplus(z: np.ndarray) -> np.ndarray:
    """log(1 + exp(-z)) in the form that does not overflow."""
    return np.log1p(np.exp(-np.abs(z))) + np.maximum(-z, 0.0)


PULLS = "feature string, step int, pull double, loss double"


def row_pulls(points: DataFrame, table: DataFrame | pa.Table, t: float = 0.0, steps: list[float] = ()) -> DataFrame:
    """Partial sums of one reading of the points, for coefficients that move from ``coef`` along ``g``.

    Rows with a feature hold its pull, the gradient of the loss without penalty at coef - t g. Rows without one hold a
    loss: at step -1 that at coef - t g, at step i that at coef - steps[i] g. A table without ``g`` stays where it is.
    Points without a label do not count.
    """
    moves = "g" in (table.columns if isinstance(table, DataFrame) else table.column_names)
    held = _collected(table, ["coef", "g"] if moves else ["coef"])

    def flushed(sums: dict[str, float], losses: np.ndarray | None) -> pa.RecordBatch:
        n = len(sums)
        at = list(range(-1, len(steps))) if losses is not None else []
        return pa.record_batch(
            {
                "feature": pa.array([*sums, *[None] * len(at)], pa.string()),
                "step": pa.array([-1] * n + at, pa.int32()),
                "pull": pa.array([*sums.values(), *[0.0] * len(at)], pa.float64()),
                "loss": pa.array([0.0] * n + (losses.tolist() if at else []), pa.float64()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, float] = {}
        losses = np.zeros(1 + len(steps))
        for batch in batches:
            rows = _Points(batch.column("x"))
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
            found = [rows.dot(c) for c in held.of(rows.features)]
            m, q = found if moves else (found[0], np.zeros(rows.n))
            losses += [softplus(y * (m - at * q)).sum() for at in (t, *steps)]
            with np.errstate(over="ignore"):
                weight = -y / (1.0 + np.exp(y * (m - t * q)))
            for feature, pull in zip(rows.features, rows.pull(weight).tolist(), strict=True):
                sums[feature] = sums.get(feature, 0.0) + pull
            if len(sums) > HELD_FEATURES:
                yield flushed(sums, None)
                sums = {}
        yield flushed(sums, losses)

    return points.where("y IS NOT NULL").select("y", "x").mapInArrow(run, PULLS)
