"""A corpus made ready for training, in five stages.

Each stage takes the documents its predecessor kept. Between stages they are written as Parquet to the session's shared
folder and read again.

Defined results of every stage: rows are told apart by their place, not by their id, so that equal rows and null ids each
count; extra columns are carried along, whatever their names, but for the last stage; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, quality, secrets, simhash
from millrace.session import prepare
from millrace.workdir import fresh_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; a null or empty text has too few words and goes."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 0.8 or more of their five-word shingles, the one of smallest id stays, null ids last; of
    equal ids, the row stored first. Null and blank texts are copies of each other, and go but for one."""
    prepare(spark)
    return simhash.keep_one(docs, similarity=0.8, width=5)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or all of a shorter one, go; null texts stay."""
    prepare(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text, overlapping ones by one mark; n_chars follows it. Null texts stay null."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in clean.columns else clean


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, decoded again to show that nothing is lost; a null text has none."""
    prepare(spark)
    vocabulary = bpe.public_vocabulary()
    coded = bpe.encode(docs.select("doc_id", "text"), vocabulary)
    back = bpe.decode(coded, vocabulary).withColumn("exact", F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary"))
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", "exact")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("byte-level BPE", byte_level_bpe),
]

#: Fingerprints and estimates have no SQL; tests/llm/test_pipeline.py holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = fresh_dir(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
