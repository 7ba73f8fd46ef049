"""Sums over the entries of a cell, for either side."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from termfit.plans.grid import Cell

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def side_sums(side: int):
    """For ``PairGrid.apply``: (id, part) with the sum of value * the other side's number, per listed id of ``side``."""

    def run(cell: Cell) -> pa.Table:
        numbers, _ = cell.vectors(1 - side, 1)
        weights = cell.values["value"] * numbers[cell.places[1 - side], 0]
        sums = np.bincount(cell.places[side], weights=weights, minlength=len(cell.ids[side])).astype(float)
        return pa.table({"id": cell.ids[side], "part": pa.array(sums)})

    return run
