"""Durable intermediate results.

Loops cut their lineage with reliable checkpoints in the shared folder that the
cluster names in ``spark.checkpoint.dir``, so losing executors costs at most the
running step.
"""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="termfit-checkpoint-")
            warnings.warn(f"spark.checkpoint.dir is not set; {shared} is used until this process ends", stacklevel=2)
            atexit.register(shutil.rmtree, shared, ignore_errors=True)
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder for a written table."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and continue from its checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run here go with the query, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Compute ``df`` now and continue from a written table, which takes less room than a checkpoint if there are many rows.

    ``options`` go to the Parquet writer.
    """
    path = scratch_path(df.sparkSession, name)
    with _shuffles_dropped(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_place(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its terms."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    files, place = hadoop_place(spark, path)
    files.delete(place, True)


class Generations:
    """Numbered generations of a loop's state in a shared folder, so that a run that ended early goes on where it was.

    A generation is a table and a record of plain values. The record is written last, so a generation without one does not
    count. Of the generations only the last two stay.
    """

    def __init__(self, spark: SparkSession, folder: str, settings: dict):
        """``settings`` tell runs apart: a folder with the state of another run is refused."""
        self.spark = spark
        self.folder = folder
        self.settings = json.loads(json.dumps(settings))

    def _path(self, number: int, name: str = "") -> str:
        return f"{self.folder}/generation-{number:08d}/{name}".rstrip("/")

    def _numbers(self) -> list[int]:
        files, place = hadoop_place(self.spark, self.folder)
        if not files.exists(place):
            return []
        names = [status.getPath().getName() for status in files.listStatus(place)]  # three at most
        return sorted(int(name.rsplit("-", 1)[1]) for name in names if name.startswith("generation-"))

    def newest(self) -> tuple[DataFrame, dict] | None:
        """The table and the record of the last whole generation."""
        for number in reversed(self._numbers()):
            files, place = hadoop_place(self.spark, self._path(number, "record.json"))
            if files.exists(place):
                record = json.loads("\n".join(row[0] for row in self.spark.read.text(self._path(number, "record.json")).collect()))
                if record["settings"] != self.settings:
                    raise ValueError(f"{self.folder} holds the state of a run with other settings: {record['settings']}")
                return self.spark.read.parquet(self._path(number, "table")), record["values"]
        return None

    def save(self, number: int, table: DataFrame, values: dict) -> DataFrame:
        """Write a generation and drop those before the last one. Returns the table as it was written."""
        table.write.mode("overwrite").parquet(self._path(number, "table"))
        files, place = hadoop_place(self.spark, self._path(number, "record.json"))
        stream = files.create(place, True)
        stream.write(json.dumps({"settings": self.settings, "values": values}).encode())
        stream.close()
        for old in self._numbers():
            if old < number - 1:
                discard(self.spark, self._path(old))
        return self.spark.read.parquet(self._path(number, "table"))
