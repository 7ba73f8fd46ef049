"""Readers for tables, text corpora and the legacy text formats."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from termfit.session import durable
from termfit.sources.folders import COMPRESSED, large_files, list_files, read_files, read_parts

# The shapes of legacy text lines. A name is quoted ('w', u'w', "w") or
# bare; numbers may carry a long suffix or a float64 wrapper.
_NAME = r"""(?:[uU]?'(.*)'|[uU]?"(.*)"|(.*?))"""
_DIGITS = r"(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"
_NUMBER = rf"(?:np\.float64\()?([-+]?(?:{_DIGITS}|[nN][aA][nN]|[iI]nf(?:inity)?))L?\)?"
PAIR_LINE = rf"^\s*\(\s*{_NAME}\s*,\s*{_NUMBER}\s*\)\s*$"
POINT_LINE = r"^\s*\(\s*(\{.*\})\s*,\s*([+-]?1)(?:\.0*)?L?\s*\)\s*$"
RATING_LINE = rf"^\s*([-+]?[0-9]+)\s*,\s*([-+]?[0-9]+)\s*,\s*([-+]?(?:{_DIGITS}|[nN][aA][nN]|[iI]nf(?:inity)?))\s*$"
SPLIT_BYTES = 128 * 1024 * 1024
#: Larger files are left to Spark's readers, by name; smaller ones may be read as one row before they are cut into parts.
SMALL_FILE = 1024 * 1024


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Read a Parquet table, spread over the executors when it is small.

    A scan of at most one split per task slot leaves slots idle and can hinge on one
    large row group, so that much (never more than a split per slot) is redistributed.
    Larger tables stay as scanned.
    """
    table = spark.read.parquet(path)
    if columns:
        table = table.select(*columns)
    slots = spark.sparkContext.defaultParallelism
    return table.repartition(slots) if table.rdd.getNumPartitions() <= slots else table


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(text): one row per line of a file, folder or glob."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def _plain_names(column: str) -> Column:
    """File names without escapes and with one way to write an empty authority."""
    plain = F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def _bytes_of(scan: DataFrame) -> DataFrame:
    """(doc_id, content) of a scan of whole files."""
    return scan.select(F.regexp_replace("path", "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/").alias("doc_id"), "content")


def _listed(scan: DataFrame) -> DataFrame:
    """(doc_id): the files that a scan has listed, those without a byte too. Their names stay in the JVM."""
    jvm = scan.sparkSession.sparkContext._jvm
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(scan._jdf.inputFiles())
    dataset = scan.sparkSession._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(dataset.toDF(), scan.sparkSession).toDF("doc_id")


def _any_compressed(scan: DataFrame) -> bool:
    return bool(_listed(scan).where(F.rlike("doc_id", F.lit(COMPRESSED))).limit(1).count())


def _in_large_tasks(scan: DataFrame) -> DataFrame:
    """Of many small files a scan gives a task 32; here a task gets SPLIT_BYTES of them, or a fourth of a slot's share."""
    partitions, slots = scan.rdd.getNumPartitions(), scan.sparkSession.sparkContext.defaultParallelism
    if len(scan._jdf.inputFiles()) < 8 * partitions:
        return scan
    size = scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return scan.coalesce(min(partitions, max(4 * slots, size // SPLIT_BYTES + 1)))


def _with_empty_files(found: DataFrame, places: list[str]) -> DataFrame:
    """``found`` (doc_id, text) and a row with an empty text for every file without a byte, which scans skip.

    Such files are those that are listed and not scanned; for that no file is opened, and it is done once.
    """
    scan = found.sparkSession.read.format("binaryFile").load(places)
    scanned = _in_large_tasks(scan.select("path")).select(F.regexp_replace("path", "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/").alias("doc_id"))
    empty = _listed(scan).select(_plain_names("doc_id").alias("doc_id")).join(scanned, "doc_id", "left_anti")
    return found.unionByName(durable(empty).withColumn("text", F.lit("")))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text): one row per file, named by its path; empty files count too.

    ``path`` is a file, folder or glob, or several of them with commas between. In local and mounted folders tasks list the files and
    read them, many to a task; other file systems, folders with folders in them and compressed files are left to Spark's own file index,
    which keeps all names on the driver. Plain files are read as bytes; where some are compressed, all go through the text source.
    """
    places = re.split(r",(?![^{}]*\})", path)  # as Hadoop reads a list of paths
    packs = list_files(spark, places, SMALL_FILE)
    if packs is not None:
        found = read_files(packs, SPLIT_BYTES)
        if large := large_files(packs):
            found = found.unionByName(_bytes_of(spark.read.format("binaryFile").load(large)))
        return found.select("doc_id", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
    scan = spark.read.format("binaryFile").load(places)
    if _any_compressed(scan):
        whole = spark.read.text(places, wholetext=True).select(_plain_names("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))
    else:
        whole = _in_large_tasks(_bytes_of(scan)).select("doc_id", F.col("content").cast("string").alias("text"))
    return _with_empty_files(whole.withColumn("text", F.make_valid_utf8("text")), places)


def read_corpus_parts(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """(doc_id, text): the files of a corpus in parts, each named by its file's path. Empty files give one empty part.

    A part is a line, or what lies between two ``separator`` characters, so that no row holds a whole file and one file is read by
    many tasks. The separator has to be white space, which no term crosses; give one that is frequent in files
    without line ends. For files of ordinary size ``read_corpus`` gives one row per file.
    """
    if separator is not None and not separator.isspace():
        raise ValueError("the separator has to be white space")
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)

    def lines(places: str | list[str]) -> DataFrame:
        return reader.text(places).select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))

    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    packs = list_files(spark, [path], min(SMALL_FILE, split))
    if packs is not None:
        found = read_parts(packs, SPLIT_BYTES, separator)
        large = large_files(packs)
        return found.unionByName(lines(large).withColumn("doc_id", _plain_names("doc_id"))) if large else found
    scan = lines(path)
    n = len(scan._jdf.inputFiles())
    if not n or scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > n * SMALL_FILE // 16 or _any_compressed(scan):
        return _with_empty_files(scan.withColumn("doc_id", _plain_names("doc_id")), [path])
    # Opening files line by line costs more than reading them. Small ones are read as bytes and cut behind that; few are larger.
    scan = spark.read.format("binaryFile").load(path)
    ends = r"\r\n|\r|\n" if separator is None else re.escape(separator)
    parts = F.split(F.regexp_replace(F.col("content").cast("string"), f"(?:{ends})\\z", ""), ends, -1)
    small = _in_large_tasks(_bytes_of(scan.where(F.col("length") <= SMALL_FILE))).select("doc_id", F.explode(parts).alias("text"))
    large = [r[0] for r in _in_large_tasks(scan.where(F.col("length") > SMALL_FILE).select("path")).collect()]  # 1 of 16 files at most
    found = small.unionByName(lines(large).withColumn("doc_id", _plain_names("doc_id"))) if large else small
    return _with_empty_files(found, [path])


def _checked(lines: DataFrame, ok: Column, mode: str, message: str, dropped: Observation | None) -> DataFrame:
    """The good lines. A bad one fails the job, whatever is selected later, or is counted and dropped.

    The check is a filter, because a check inside a column disappears with a column that nobody reads.
    """
    if mode == "drop":
        if dropped is not None:
            lines = lines.observe(dropped, F.count_if(~ok).alias("dropped"))
        return lines.where(ok)
    problem = F.raise_error(F.concat(F.lit(message + ": "), F.col("value"))).cast("boolean")
    return lines.where(F.when(ok, F.lit(True)).otherwise(problem))


def _check_mode(mode: str) -> None:
    if mode not in ("fail", "drop"):
        raise ValueError("mode is 'fail' or 'drop'")


def _unescape(name: Column) -> Column:
    r"""Decode \xNN, \uNNNN, \\ and quote escapes in a quoted name."""
    as_json = F.regexp_replace(name, r"""\\'""", "'")
    as_json = F.regexp_replace(as_json, r"""(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})""", r"$1\\u00$2")
    as_json = F.regexp_replace(as_json, r"""(?<!\\)((?:\\\\)*)\"""", r"""$1\\\"""")
    decoded = F.from_json(F.concat(F.lit('["'), as_json, F.lit('"]')), "array<string>")[0]
    return F.when(F.contains(name, F.lit("\\")), decoded).otherwise(name)


def read_pairs(
    spark: SparkSession, path: str, mode: str = "fail", dropped: Observation | None = None
) -> DataFrame:
    """(term, value) from ``(term, value)`` lines: term scores or model coefficients.

    A line of any other shape fails the job, or is left out with ``mode="drop"``; then the
    observation ``dropped`` counts such lines as ``dropped`` when the table is computed. Blank
    lines are skipped in both modes.
    """
    _check_mode(mode)
    line = F.col("value")
    lines = spark.read.text(path).where(F.trim(line) != "")
    matches = F.rlike(line, F.lit(PAIR_LINE))
    lines = _checked(lines, matches, mode, "not a (term, value) line", dropped)
    quoted = F.concat(F.regexp_extract(line, PAIR_LINE, 1), F.regexp_extract(line, PAIR_LINE, 2))
    name = F.concat(_unescape(quoted), F.regexp_extract(line, PAIR_LINE, 3))
    number = F.regexp_extract(line, PAIR_LINE, 4)
    return lines.select(name.alias("term"), number.cast("double").alias("value"))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """(user_id, item_id, rating) from ``user,item,rating`` lines.

    A line with an empty or malformed field, or an id beyond 64 bits, fails the job; blank lines are skipped.
    """
    line = F.col("value")
    lines = spark.read.text(path).where(F.trim(line) != "")
    users, items = (F.regexp_extract(line, RATING_LINE, k).try_cast("bigint") for k in (1, 2))
    matches = F.rlike(line, F.lit(RATING_LINE)) & users.isNotNull() & items.isNotNull()
    lines = _checked(lines, matches, "fail", "not a user,item,rating line", None)
    rating = F.regexp_extract(line, RATING_LINE, 3).cast("double")
    return lines.select(users.alias("user_id"), items.alias("item_id"), rating.alias("rating"))


def read_folds(spark: SparkSession, folder: str, folds: int) -> DataFrame:
    """Ratings of ``fold0`` ... ``fold<folds-1>`` with their fold number."""
    parts = [
        read_ratings(spark, f"{folder}/fold{k}").withColumn("fold", F.lit(k)) for k in range(folds)
    ]
    return reduce(DataFrame.unionByName, parts)


def _as_json(features: Column) -> Column:
    """A dictionary as its repr writes it, as JSON: no prefixes, suffixes or wrappers, quoted keys, known escapes."""
    steps = (
        (r"""([{,]\s*)[uU](['"])""", "$1$2"),
        (r"""(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})""", r"$1\\u00$2"),
        (rf"""(:\s*)np\.float64\(\s*([-+]?{_DIGITS})\s*\)""", "$1$2"),
        (r"""(:\s*[-+]?[0-9]+)L(\s*[,}])""", "$1$2"),
        (r"""([{,]\s*)([-+]?[0-9]+(?:\.[0-9]*)?)L?(\s*:)""", '$1"$2"$3'),
        (r""",\s*\}$""", "}"),
    )
    for pattern, by in steps:
        features = F.regexp_replace(features, pattern, by)
    return features


def read_labelled(
    spark: SparkSession, path: str, mode: str = "fail", dropped: Observation | None = None
) -> DataFrame:
    """(row_id, y, x) from ``({feature: value, ...}, label)`` lines with labels +1 and -1.

    Bad lines are treated as in ``read_pairs``. ``row_id`` follows the position in the scan: store the table
    (Parquet keeps the map) before using the ids across jobs.
    """
    _check_mode(mode)
    line = F.col("value")
    lines = spark.read.text(path).where(F.trim(line) != "")
    features = _as_json(F.regexp_extract(line, POINT_LINE, 1))
    x = F.from_json(features, "map<string,double>", {"allowBackslashEscapingAnyCharacter": "true"})
    label = F.regexp_extract(line, POINT_LINE, 2)
    parsed = F.rlike(line, F.lit(POINT_LINE)) & x.isNotNull()
    lines = _checked(lines, parsed, mode, "not a ({feature: value}, label) line", dropped)
    return lines.select(
        F.monotonically_increasing_id().alias("row_id"), label.cast("int").alias("y"), x.alias("x")
    )
