"""Writers for corpora, term scores, ranked lists and scalars."""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfit.session import durable, hadoop_place

# The functions below run in Python workers, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _write_files(folder: str):
    """A file for every row. A task that runs again replaces what it wrote; a file appears when it is whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        hidden = os.path.join(folder, f".{task.partitionId():06d}-{task.taskAttemptId()}")
        n = 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                with open(hidden, "wb") as file:
                    file.write((text.as_py() or b"") + b"\n")
                os.replace(hidden, os.path.join(folder, f"part-{task.partitionId():06d}-{n:09d}.txt"))
                n += 1
        yield pa.record_batch({"n": pa.array([n], pa.int64())})

    return run


def write_corpus(docs: DataFrame, path: str, text: str = "text") -> None:
    """Write every document to a file of its own in the new folder ``path``, as ``read_corpus`` reads it: UTF-8 and a line end.

    In a local or mounted folder the tasks create the files themselves: Hadoop's local file system starts a process for each file's
    permissions, and the driver moves all of them in place one by one. Other file systems are left to Spark's writer.
    """
    docs = docs.select(text)
    files, place = hadoop_place(docs.sparkSession, path)
    if files.getUri().getScheme() != "file":
        docs.write.option("maxRecordsPerFile", 1).text(path)
        return
    if files.exists(place):
        raise FileExistsError(path)
    files.mkdirs(place)
    docs.mapInArrow(_write_files(place.toUri().getPath()), "n bigint").agg(F.sum("n")).first()


def write_scores(scores: DataFrame, path: str, format: str = "parquet") -> None:
    """Write a score table; ``format="text"`` gives ``('term', value)`` lines.

    The text form needs exactly two columns, the term and its value.
    """
    if format == "parquet":
        scores.write.parquet(path)
    elif format == "text":
        term, value = _two_columns(scores)
        scores.select(F.format_string("('%s', %s)", _quote(term), value.cast("string"))).write.text(path)
    else:
        raise ValueError("format is 'parquet' or 'text'")


def _two_columns(table: DataFrame) -> tuple[Column, Column]:
    if len(table.columns) != 2:
        raise ValueError(f"(term, value) lines hold two columns, not {table.columns}")
    term, value = table.columns
    return F.col(term), F.col(value)


def _quote(term: Column) -> Column:
    return F.regexp_replace(term, r"([\\'])", r"\\$1")


#: Rows of a ranked list, which one task sorts and writes.
MOST_RANKED = 1_000_000


def write_ranked(top: DataFrame, path: str) -> None:
    """Write the few rows of a top list (term, value) as ``(term, value)`` lines, largest value first.

    A table of more than MOST_RANKED rows is refused; ``top_terms`` cuts it.
    """
    term, value = _two_columns(top)
    top = durable(top.limit(MOST_RANKED + 1))  # all of it, if it is a list of that size
    if top.count() > MOST_RANKED:
        raise ValueError(f"a ranked list has at most {MOST_RANKED} rows")
    lines = top.coalesce(1).sortWithinPartitions(value.desc(), term.asc())
    lines.select(F.format_string("(%s, %f)", term, value.cast("double"))).write.text(path)


def write_scalar(row: DataFrame, path: str) -> None:
    """Write the single value of a one-row, one-column table with six decimals."""
    row.select(F.format_string("%f", F.col(row.columns[0]).cast("double"))).write.text(path)
