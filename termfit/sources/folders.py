"""Corpora of many small files in local or mounted folders: tasks list and read them, so the driver holds no file's name."""

from __future__ import annotations

import os
import re
import stat
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termfit.session import hadoop_place, stored

# The functions below run in Python workers, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Files are handed on in packs of so many bytes or files.
PACK_BYTES = 1024 * 1024
PACK_FILES = 1000
#: Names of files that Hadoop's codecs unpack.
COMPRESSED = r"\.(gz|gzip|bz2|deflate|zst|lz4|snappy|lzo|passthrough)$"
_ENTRY = "path binary, folder boolean"
_PACK = "folder binary, names array<binary>, bytes bigint, large boolean, other boolean"


def _patterns(spark: SparkSession, path: str) -> list[str]:
    """The components of a glob as regular expressions, in Hadoop's own translation."""
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern
    return [glob(name).compiled().pattern() for name in path.split("/") if name]


def _places(spark: SparkSession, places: list[str]) -> list[tuple[str, list[str]]] | None:
    """(folder, patterns of what lies below it) for each place, or None where tasks cannot list them as Spark's file index does."""
    found = []
    for place in places:
        files, path = hadoop_place(spark, place)
        if files.getUri().getScheme() != "file":
            return None
        name = files.makeQualified(path).toUri().getPath()
        if not re.search(r"[{}\[\]*?\\]", name):
            if not files.exists(path):
                return None
            found.append((name, []))
        elif re.search(r"\{[^}]*/", name) or "\\/" in name:
            return None
        else:
            fixed = re.match(r"(?:/[^/{}\[\]*?\\]*(?=/))*", name).group()
            found.append((fixed or "/", _patterns(spark, name[len(fixed) :])))
    return found


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files and folders that globs stand for."""

    def below(folder: bytes, patterns: list[str]) -> Iterator[bytes]:
        if not patterns:
            yield folder
            return
        wanted = re.compile(patterns[0], re.DOTALL)
        if os.path.isdir(folder):
            with os.scandir(folder) as found:
                for entry in found:
                    if wanted.fullmatch(entry.name.decode(errors="replace")):
                        yield from below(entry.path, patterns[1:])

    for batch in batches:
        for place in batch.to_pylist():
            some: list[bytes] = []
            for path in below(os.fsencode(place["folder"]), place["patterns"]):
                some.append(path)
                if len(some) == PACK_FILES:
                    yield _entries(some)
                    some = []
            yield _entries(some)


def _entries(paths: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch({"path": pa.array(paths, pa.binary()), "folder": pa.array([os.path.isdir(p) for p in paths], pa.bool_())})


def _packs(most: int):
    """Packs of the files that a list of files and folders stands for. ``large``: a file of more than ``most`` bytes, alone; ``other``: something
    that only Spark's file index and readers treat right."""
    compressed = re.compile(COMPRESSED.encode())

    def hidden(name: bytes) -> bool:
        # as Spark's file index leaves them out
        return name.startswith(b"_") and b"=" not in name or name.startswith(b".") or name.endswith(b"._COPYING_")

    def pack(folder: bytes, names: list[bytes], size: int, large: bool = False, other: bool = False) -> pa.RecordBatch:
        schema = pa.schema([("folder", pa.binary()), ("names", pa.list_(pa.binary())), ("bytes", pa.int64()), ("large", pa.bool_()), ("other", pa.bool_())])
        return pa.RecordBatch.from_pylist([{"folder": folder, "names": names, "bytes": size, "large": large, "other": other}], schema)

    def children(path: bytes, folder: bool) -> Iterator[tuple[bytes, bytes]]:
        if not folder:
            yield os.path.split(path)
            return
        with os.scandir(path) as found:
            for entry in found:
                yield path, entry.name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, size = b"", [], 0
        for batch in batches:
            for entry in batch.to_pylist():
                for folder, name in children(entry["path"], entry["folder"]):
                    if hidden(name) and not name.startswith((b"_common_metadata", b"_metadata")):
                        continue
                    try:
                        status = os.stat(os.path.join(folder, name))
                    except FileNotFoundError:  # a link to nothing
                        continue
                    length = status.st_size
                    if stat.S_ISDIR(status.st_mode) or hidden(name) or compressed.search(name):
                        yield pack(folder, [name], 0, other=True)
                        return
                    if length > most:
                        yield pack(folder, [name], length, large=True)
                        continue
                    if names and (folder != at or size + length > PACK_BYTES or len(names) == PACK_FILES):
                        yield pack(at, names, size)
                        names, size = [], 0
                    at = folder
                    names.append(name)
                    size += length
        if names:
            yield pack(at, names, size)

    return run


def list_files(spark: SparkSession, places: list[str], most: int) -> DataFrame | None:
    """Packs of files (folder, names, bytes, large), listed by tasks and stored; files of more than ``most`` bytes come alone, as large ones.

    ``places`` are files, folders and globs. None where Spark's own index has to list them: in other file systems, and where there is no
    file, a compressed one or a folder in a folder.
    """
    found = _places(spark, places)
    if found is None:
        return None
    slots = spark.sparkContext.defaultParallelism
    start = spark.createDataFrame(found, "folder string, patterns array<string>").repartition(min(slots, len(found)))
    packs = stored(start.mapInArrow(_matches, _ENTRY).repartition(slots).mapInArrow(_packs(most), _PACK), "files")
    n, other = packs.agg(F.count(F.lit(1)), F.coalesce(F.bool_or("other"), F.lit(False))).first()
    return packs.drop("other") if n and not other else None


def _contents(kind: pa.DataType, cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, names in zip(batch.column("folder").to_pylist(), batch.column("names").to_pylist(), strict=True):
                found = []
                for name in names:
                    with open(os.path.join(folder, name), "rb") as file:
                        found.append(cut(file.read()))
                paths = [(b"file:" + os.path.join(folder, name)).decode(errors="replace") for name in names]
                yield pa.record_batch({"doc_id": pa.array(paths, pa.string()), "content": pa.array(found, kind)})

    return run


def _dealt(packs: DataFrame, task_bytes: int) -> DataFrame:
    """The packs of small files. A task gets ``task_bytes`` of them, or a fourth of a slot's share."""
    small = packs.where("NOT large")
    n, size = small.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(4 * packs.sparkSession.sparkContext.defaultParallelism, size // task_bytes + 1)
    return small.select("folder", "names").repartition(max(1, min(n, tasks)))


def read_files(packs: DataFrame, task_bytes: int) -> DataFrame:
    """(doc_id, content): the small files of listed packs, whole."""
    return _dealt(packs, task_bytes).mapInArrow(_contents(pa.binary(), lambda data: data), "doc_id string, content binary")


def read_parts(packs: DataFrame, task_bytes: int, separator: str | None) -> DataFrame:
    """(doc_id, text): the lines of these files, or what lies between two separators. An empty file gives one empty part."""
    between = separator and separator.encode()

    def cut(data: bytes) -> list[bytes]:
        # bytes end a line at \n, \r and \r\n only
        return data.removesuffix(between).split(between) if between else data.splitlines() or [b""]

    parts = _dealt(packs, task_bytes).mapInArrow(_contents(pa.list_(pa.binary()), cut), "doc_id string, content array<binary>")
    return parts.select("doc_id", F.explode("content").alias("text")).withColumn("text", F.make_valid_utf8(F.col("text").cast("string")))


def large_files(packs: DataFrame) -> list[str]:
    """The large files, as names that Hadoop does not take for globs. Their number is bounded by their bytes."""
    found = packs.where("large").select("folder", F.col("names")[0]).collect()
    return ["file:" + re.sub(r"([{}\[\]*?\\])", r"\\\1", os.fsdecode(os.path.join(bytes(a), bytes(b)))) for a, b in found]
