"""From documents to token ids in five stages, each written and read again by ``run``.

Every stage takes (spark, docs, sf_dir) and judges all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termfit.llm import bpe, credentials, jaccard, queries, tiling
from termfit.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. Rows are judged one by one."""
    judged = queries.fitted_quality(spark, docs, sf_dir, carry=COLUMNS)
    return judged.where("kept").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the row with the smallest doc_id stays.

    Repeated rows of it stay once; different texts with one doc_id are judged each for itself; rows without doc_id stay as they are.
    """
    return jaccard.first_of_groups(docs.select(COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return tiling.decontaminated(docs.select(COLUMNS), benchmark)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place; n_chars follows the text. No document goes."""
    masked = credentials.masked(docs.select(COLUMNS), F.col("source"), F.concat_ws("/", "source", "lang"))
    return masked.withColumn("n_chars", F.length("text").cast("bigint"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the token ids of every document left."""
    encoded = bpe.encode(docs, queries.bpe_path())
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("BPE encoding", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Tiling and pair merging cannot be written in SQL; tests/llm compares every stage and ``run`` with plain Python.
ORACLE_SQL = None
