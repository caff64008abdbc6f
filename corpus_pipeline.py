"""The corpus pipeline: documents of quality, one of each group of near copies, none that holds benchmark passages, in the
wanted mix of sources, as token files.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; `run` writes it to the shared folder as
Parquet and reads it again for the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.decontaminate import decontaminate
from encore.llm.mixing import mixed_copies
from encore.llm.quality import score_quality
from encore.llm.simhash import keep_representatives
from encore.llm.tokenfiles import token_table
from encore.session import prepare
from encore.storage import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    prepare(spark)
    # The row as one column: whatever its columns are called, they come back as they were.
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    scored = score_quality(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.filter("predicted = 1").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: four-word shingles, fingerprints linked at 4 or fewer differing bits."""
    prepare(spark)
    return keep_representatives(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    prepare(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it: 0 to 3 equal rows."""
    prepare(spark)
    return mixed_copies(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: doc_id, start, n_tokens and ids_crc32 of every copy."""
    prepare(spark)
    return token_table(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mixture),
    ("token-ID / binary output", tokens),
]

# Trained scores, hash signatures and random rounding are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    sf_dir = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0].lower().replace("/", "-"))
    return docs
