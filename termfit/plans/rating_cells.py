"""One descent step over ratings that stay in the cells of a grid."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfit.operators.factors import ITEM, USER, part_width, pull_columns, step_summed, stretches
from termfit.plans.grid import Cell, PairGrid, blocks_for

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VALUES = {"rating": "double", "fold": "int", "weight": "bigint"}


def _sums(place: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(place, weights=values, minlength=n).astype(float)  # without rows the counts are whole numbers


def _pulls(models: list[int], parts: list[tuple[int, int, int, int, int]], d: int, width: int):
    """For ``PairGrid.apply``: each listed id's summed pulls by part, NULL for a model that no scored row of the cell trains."""

    def run(cell: Cell) -> pa.Table:
        vectors, known = zip(*(cell.vectors(side, len(models) * d) for side in (USER, ITEM)), strict=True)
        rating, fold, weight = (cell.values[name] for name in VALUES)
        whole = [known[side].reshape(-1, len(models), d).all(axis=2) for side in (USER, ITEM)]
        residuals = []
        for i, model in enumerate(models):
            scored = whole[USER][cell.places[USER], i] & whole[ITEM][cell.places[ITEM], i]
            delta = -rating
            for k in range(i * d, (i + 1) * d):
                delta += vectors[USER][cell.places[USER], k] * vectors[ITEM][cell.places[ITEM], k]
            residuals.append((delta, scored & (fold != model), scored & (fold == model)))
        tables = []
        for side in (USER, ITEM):
            n = len(cell.ids[side])
            for part, m, c, start, size in parts:
                delta, trains, tests = residuals[m]
                at, other = cell.places[side][trains], cell.places[1 - side][trains]
                idle = np.bincount(at, minlength=n) == 0
                push = 2.0 * delta[trains] * weight[trains]
                columns = {
                    "side": pa.array(np.full(n, side, np.int32)),
                    "id": cell.ids[side],
                    "part": pa.array(np.full(n, part, np.int32)),
                }
                for j in range(width):
                    if j < size:
                        sums = _sums(at, push * vectors[1 - side][other, start + j], n)
                        columns[f"_g{j}"] = pa.array(sums, mask=idle)
                    else:
                        columns[f"_g{j}"] = pa.nulls(n, pa.float64())
                place = cell.places[side]
                books = side == USER and c == 0  # errors are booked once, on the user
                for name, rows in (("sq_error", trains), ("held_error", tests)):
                    columns[name] = pa.array(_sums(place[rows], (delta**2 * weight)[rows], n)) if books else pa.nulls(n, pa.float64())
                for name, rows in (("held_rows", tests), ("rows", trains)):
                    columns[name] = pa.array(_sums(place[rows], weight[rows], n).astype(np.int64) if books else np.zeros(n, np.int64))
                tables.append(pa.table(columns))
        return pa.concat_tables(tables)

    return run


class RatingGrid:
    """Fold-tagged ratings for two large sides: they are laid out in cells once, and only profiles and pulls move."""

    def __init__(self, ratings: DataFrame, sizes: list[int], width: int, partitions: int | None):
        """``sizes`` are the numbers of users and items, ``width`` the elements of a vector."""
        row = ["user_id", "item_id", "rating", "fold"]
        merged = ratings.groupBy(*row).agg(F.count(F.lit(1)).alias("weight"))
        spark = ratings.sparkSession
        slots = partitions or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        blocks = blocks_for(ratings.count(), *(n * (64 + 8 * width) for n in sizes), slots)
        self.grid = PairGrid(merged, "user_id", "item_id", VALUES, blocks, slots)
        self.id_kind = ratings.schema["user_id"].dataType.simpleString()

    def step(self, profiles: DataFrame, models: list[int], gammas: list[float], lam: float, mu: float, d: int) -> DataFrame:
        """(side, id, factors, parts): as ``step_models`` over all ratings."""
        vectors = profiles.select("side", "id", F.col("factors").alias("vector"))
        sent = [self.grid.send(side, vectors.where(F.col("side") == side).drop("side")) for side in (USER, ITEM)]
        pulls = ", ".join(f"{name} double" for name in pull_columns(d))
        schema = f"side int, id {self.id_kind}, part int, {pulls}, sq_error double, held_error double, held_rows bigint, rows bigint"
        run = _pulls(models, stretches(len(models), d), d, part_width(d))
        return step_summed(self.grid.apply(run, schema, *sent), profiles, gammas, lam, mu, d)

    def release(self) -> None:
        self.grid.release()
