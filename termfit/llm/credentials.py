"""Secret scans with corpus-wide ownership frequency.

Patterns find candidates in every text. How many distinct owners and repositories hold a
candidate value separates examples that are copied widely from credentials that belong
to one owner: a value held by up to ``max_owners`` owners in up to ``max_repositories`` repositories looks live. The fixed patterns
(``assign``, ``access``, ``hex``) are always reported; opaque tokens (kind ``owned``) are added
where their ownership says that they are live. Values travel as hashes only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfit.llm.words import slices
from termfit.plans.joins import lookup
from termfit.session import durable, scratch_path

#: Most distinct owners, and repositories, of a value that still looks live.
MAX_OWNERS = 2
MAX_REPOSITORIES = 8

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")
KINDS = ("assign", "access", "hex", "owned")

SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint,value:string>"


def _value(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def candidate_spans(text: str) -> list[tuple[int, int, str, int, str]]:
    """(start, rank of the kind, kind, end, hash of the value) of every candidate, ordered."""
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                found.append((m.start(), 0, "assign", m.end(), _value(m[2])))
    if "AKIA" in text:
        found += [(m.start(), 1, "access", m.end(), _value(m[0])) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, "hex", m.end(), _value(m[0])) for m in HEX.finditer(text)]
    taken = [(start, end) for start, _, _, end, _ in found]
    for m in OPAQUE.finditer(text):
        word = m[0]
        mixed = any(c.isdigit() for c in word) and word != word.lower() and word != word.upper()
        if mixed and not any(start < m.end() and m.start() < end for start, end in taken):
            found.append((m.start(), 3, "owned", m.end(), _value(word)))
    return sorted(found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("start", "rank", "kind", "end", "value")
    kind = pa.list_(pa.struct(zip(names, (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string()), strict=True)))
    for whole in batches:
        for batch in slices(whole):
            spans = [
                [dict(zip(names, s, strict=True)) for s in candidate_spans(t)] if t else []
                for t in batch.column("text").to_pylist()
            ]
            kept = [n for n in batch.schema.names if n != "text"]
            columns = [batch.column(n) for n in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], [*kept, "spans"])


def scan(
    docs: DataFrame,
    owner: Column,
    repository: Column,
    max_owners: int = MAX_OWNERS,
    carry: list[str] | None = None,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its spans.

    Returns doc_id and spans, an array of (start, rank, kind, end, value, n_owners, n_repositories,
    live) ordered by start and kind; offsets are code points, ends exclusive. The columns named in
    ``carry`` come along as struct ``carried``. A null text is empty. Rows without an owner or
    repository count as one unnamed owner or repository. Repeated rows are scanned one by one
    and count once for their owner.
    """
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id",
        F.col("text").cast("string").alias("text"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("text").schema]
    found = rows.mapInArrow(_scan, ", ".join([*fields, f"spans array<{SPAN}>"]))
    path = scratch_path(spark, "spans")
    found.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    found = spark.read.parquet(path)  # from here on nothing is scanned again
    some = F.size("spans") > 0
    each = found.where(some).select("row", "owner", "repository", F.explode("spans").alias("s"))
    held = each.select(F.col("s.value").alias("value"), "owner", "repository").distinct()
    held = held.groupBy("value", "owner").agg(F.count("*").alias("n"))
    held = durable(held.groupBy("value").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories")))
    # a value that is copied everywhere is split where the counts do not fit a broadcast
    judged = lookup(each.select("row", "s", F.col("s.value").alias("value")), held, "value", by=["row"])
    judged = judged.withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories))
    span = F.struct("s.start", "s.rank", "s.kind", "s.end", "s.value", "n_owners", "n_repositories", "live")
    judged = judged.where("s.kind <> 'owned' OR live")
    judged = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    columns = ["doc_id", *(["carried"] if carry else [])]
    empty = F.array().cast(judged.schema["spans"].dataType)
    # Only rows with a candidate are shuffled.
    with_spans = found.where(some).select("row", *columns).join(judged, "row", "left")
    with_spans = with_spans.select(*columns, F.coalesce("spans", empty).alias("spans"))
    return with_spans.union(found.where(~some).select(*columns, empty.alias("spans")))


def _mask(by: str):
    """Cut each text once into what lies between its spans; overlapping spans count as one."""

    def masked(text: str | None, starts: list[int], ends: list[int]) -> str | None:
        if text is None or not starts:
            return text
        pieces, at = [], 0
        for start, end in zip(starts, ends, strict=True):
            if start >= at:
                pieces += [text[at:start], by]
            at = max(at, end)
        return "".join([*pieces, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            carried, spans = batch.column("carried"), batch.column("spans")
            starts, ends = ([[s[k] for s in row] for row in spans.to_pylist()] for k in ("start", "end"))
            names = [f.name for f in carried.type]
            columns = dict(zip(names, carried.flatten(), strict=True))
            columns["text"] = pa.array(map(masked, columns["text"].to_pylist(), starts, ends), pa.string())
            yield pa.record_batch(columns)

    return run


def masked(docs: DataFrame, owner: Column, repository: Column, max_owners: int = MAX_OWNERS, by: str = "[secret]") -> DataFrame:
    """``docs`` with all its columns and the reported spans masked in ``text``."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    scanned = scan(docs, owner, repository, max_owners, carry=docs.columns).select("carried", "spans")
    return scanned.mapInArrow(_mask(by), docs.schema)


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(parts, ",")


def summary(scanned: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the fixed patterns' spans and all spans as text."""

    def count(what) -> Column:
        return F.size(F.filter("spans", what)).cast("bigint")

    def of_kind(kind: str) -> Column:
        return count(lambda s: s["kind"] == kind).alias(f"n_{kind}")

    return scanned.select(
        "doc_id",
        *map(of_kind, KINDS[:3]),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "owned")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_example"),
    )
