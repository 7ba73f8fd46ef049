"""Term counts of documents that come in parts, added up where the parts are read."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# The functions below run in Python workers, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Terms of one document that a task keeps until its next part comes.
HELD_TERMS = 500_000
#: Rows that are worked on at once; a worker's memory follows from that.
ROWS = 2000


def _codes(column: pa.Array) -> np.ndarray:
    """A number for every value; equal ones, and NULLs, get the same."""
    return column.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _summed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row per document with the sums of its rows' counts, sorted by term."""
    docs, counts = batch.columns
    doc = _codes(docs)
    first = np.unique(doc, return_index=True)[1]
    sizes = pc.fill_null(pc.list_value_length(counts), 0).to_numpy(zero_copy_only=False)
    flat = counts.flatten()
    words = flat.field("term").dictionary_encode()
    by_term = pc.sort_indices(words.dictionary).to_numpy()
    place = np.empty(len(by_term), np.int64)
    place[by_term] = np.arange(len(by_term))
    key = np.repeat(doc, sizes) * max(1, len(by_term)) + place[words.indices.to_numpy(zero_copy_only=False)]
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    tf = np.add.reduceat(flat.field("tf").to_numpy(zero_copy_only=False)[order], starts) if len(starts) else np.array([], np.int64)
    owner, word = np.divmod(key[starts], max(1, len(by_term)))
    offsets = pa.array(np.searchsorted(owner, np.arange(len(first) + 1)), pa.int32())
    terms = pa.StructArray.from_arrays([words.dictionary.take(pa.array(by_term[word])), pa.array(tf, pa.int64())], ["term", "tf"])
    return pa.record_batch([docs.take(pa.array(first)), pa.ListArray.from_arrays(offsets, terms)], names=batch.schema.names)


def _pieces(most: int, at_once: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        batch = rows = None
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                rows = pa.Table.from_batches([*held, batch.slice(start, at_once)]).combine_chunks().to_batches()[0]
                doc = _codes(rows.column(0))
                others = np.flatnonzero(doc != doc[-1])
                last = others[-1] + 1 if len(others) else 0
                if last:
                    yield _summed(rows.slice(0, last))
                held = [rows.slice(last)]
                if len(held[0].column(1).flatten()) > most:
                    yield _summed(held.pop())
        for rows in held:
            yield _summed(rows)
        del held, batch, rows
        pa.default_memory_pool().release_unused()  # the worker waits for other tasks beside the JVM

    return run


def add_up_in_place(counted: DataFrame) -> DataFrame:
    """(doc, counts) with fewer rows for the same documents, from a table of these two columns.

    Rows of a document that follow each other in a task become one, unless they have very many terms. Nothing is
    exchanged, so a document whose rows lie elsewhere too still has several.
    """
    doc, counts = counted.schema
    return counted.mapInArrow(_pieces(HELD_TERMS, ROWS), StructType([doc, counts]))
