"""Large sets of (left, right, values) pairs that stay in place while vectors travel.

The pairs of a left block and a right block form a cell: one row with the ids that the cell
lists and the pairs as packed arrays. Cells are laid out once and never move again. A routing list per
side says which cells list an id, so that an id's vector is sent once to every cell that
needs it, and a cell sums what its pairs contribute to an id before anything is sent back.
Traffic is one vector per id and listing cell, however many pairs there are.

Left ids with more than a fair share of the pairs are split over several blocks; a right id is
spread by the left ids that it meets.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfit.plans.joins import add_salt, hot_keys
from termfit.session import durable

# The functions below run in Python workers, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEFT, RIGHT = 0, 1
#: Pairs of a cell on average, and bytes of the vectors of one side of a cell.
CELL_PAIRS = 1_000_000
CELL_BYTES = 64 * 1024 * 1024


def blocks_for(pairs: int, left_bytes: int, right_bytes: int, slots: int) -> tuple[int, int]:
    """How many left and right blocks keep cells within CELL_PAIRS and CELL_BYTES; at least one cell per slot."""
    right = max(1, -(-right_bytes // CELL_BYTES))
    left = max(1, -(-left_bytes // CELL_BYTES), -(-pairs // (CELL_PAIRS * right)), -(-slots // right))
    return left, right


def _codes(ids: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct ids in order, and the place of each id among them."""
    coded = ids.combine_chunks().dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    place = np.empty(len(order), np.int32)
    place[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
    return coded.dictionary.take(order), place[coded.indices.to_numpy()]


def _pack(values: list[str]) -> Callable[[pa.Table], pa.Table]:
    """One row for a cell's pairs; its content does not depend on their order of arrival."""

    def run(pairs: pa.Table) -> pa.Table:
        pairs = pairs.take(pc.sort_indices(pairs, sort_keys=[(c, "ascending") for c in ("left", "right", *values)]))
        left, at = _codes(pairs.column("left"))
        right, to = _codes(pairs.column("right"))
        columns = {
            "cell": pairs.column("cell").slice(0, 1),
            "left_ids": pa.array([left.to_pylist()], pa.list_(left.type)),
            "right_ids": pa.array([right.to_pylist()], pa.list_(right.type)),
            "at": pa.array([at.tobytes()], pa.binary()),
            "to": pa.array([to.tobytes()], pa.binary()),
        }
        for name in values:
            columns[name] = pa.array([pairs.column(name).to_numpy().tobytes()], pa.binary())
        return pa.table(columns)

    return run


class Cell:
    """One cell in a Python worker: its ids, its pairs by place, and the vectors that were sent to it."""

    def __init__(self, cells: pa.Table, sent: pa.Table, kinds: dict[str, type]):
        self.ids = [cells.column(name).combine_chunks().flatten() for name in ("left_ids", "right_ids")]
        self.places = [np.frombuffer(cells.column(name)[0].as_buffer(), np.int32) for name in ("at", "to")]
        self.values = {name: np.frombuffer(cells.column(name)[0].as_buffer(), kind) for name, kind in kinds.items()}
        self.sent = sent

    def vectors(self, side: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(n, width) vectors of one side's ids and which of their elements are there; the others are 0."""
        n = len(self.ids[side])
        values, known = np.zeros((n, width)), np.zeros((n, width), bool)
        mine = self.sent.filter(pc.equal(self.sent.column("side"), side))
        if mine.num_rows:
            place = mine.column("place").to_numpy()
            flat = mine.column("vector").combine_chunks().flatten()
            known[place] = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width)
            values[place] = pc.fill_null(flat, 0.0).to_numpy().reshape(-1, width)
        return values, known


class PairGrid:
    """Pairs (``left``, ``right``, values) laid out in cells, cached, with their routing lists.

    ``values`` maps each further column to its type, ``double``, ``int`` or ``bigint``. ``partitions`` is the number of
    partitions that the cells lie in.
    """

    TYPES = {"double": np.float64, "int": np.int32, "bigint": np.int64}

    def __init__(self, pairs: DataFrame, left: str, right: str, values: dict[str, str], blocks: tuple[int, int], partitions: int):
        self.kinds = {name: self.TYPES[kind] for name, kind in values.items()}
        spread = [left, right, *values]
        hot = durable(hot_keys(pairs.groupBy(left).count(), left))
        salted = add_salt(pairs, left, hot, "_salt", by=spread)
        cell = F.pmod(F.xxhash64(left, "_salt"), F.lit(blocks[0])) * blocks[1] + F.pmod(F.xxhash64(right), F.lit(blocks[1]))
        rows = salted.select(
            cell.alias("cell"), F.col(left).alias("left"), F.col(right).alias("right"), *[F.col(n).cast(k).alias(n) for n, k in values.items()]
        )
        types = [pairs.schema[c].dataType.simpleString() for c in (left, right)]
        schema = f"cell bigint, left_ids array<{types[0]}>, right_ids array<{types[1]}>, at binary, to binary"
        packed = rows.groupBy("cell").applyInArrow(_pack(list(values)), ", ".join([schema, *(f"{n} binary" for n in values)]))
        self.cells = self._kept(packed, partitions, "cell")
        lists = [self.cells.select(F.posexplode(ids).alias("place", "id"), "cell") for ids in ("left_ids", "right_ids")]
        self.routes = [self._kept(routes, partitions, "id") for routes in lists]

    @staticmethod
    def _kept(table: DataFrame, partitions: int, key: str) -> DataFrame:
        table = table.repartition(partitions, key).sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK)
        # plans know the partitioning and order of a cached table once it is filled
        table.count()
        return table

    def send(self, side: int, vectors: DataFrame) -> DataFrame:
        """(cell, side, place, vector) for (id, vector) rows: one for every cell that lists the id."""
        routed = self.routes[side].join(vectors.where("vector IS NOT NULL"), "id")
        return routed.select(F.col("cell").alias("cell"), F.lit(side).alias("side"), "place", "vector")

    def apply(self, run: Callable[[Cell], pa.Table], schema: str, *sent: DataFrame) -> DataFrame:
        """What ``run`` makes of every cell and the vectors sent to it. Only the vectors are exchanged."""
        kinds = self.kinds

        def cell(cells: pa.Table, vectors: pa.Table) -> pa.Table:
            return run(Cell(cells, vectors, kinds))

        vectors = reduce(DataFrame.unionByName, sent)
        return self.cells.groupBy("cell").cogroup(vectors.groupBy("cell")).applyInArrow(cell, schema)

    def release(self) -> None:
        for table in (self.cells, *self.routes):
            table.unpersist()
