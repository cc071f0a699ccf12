"""The training-data pipeline: language ID, near dedup, decontamination, secret masking, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet under the shared checkpoint folder and reads it
again for the next, so a lost executor costs one stage's tasks at most.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm.decontaminate import decontaminate
from plantlake.llm.language_id import identify_documents
from plantlake.llm.mixing import repeat
from plantlake.llm.near_dup import keep_one
from plantlake.llm.secret_scan import redact_secrets
from plantlake.llm.shared import fresh, new_folder, ship_package


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is accepted; ``lang`` becomes the identified one."""
    ship_package(spark)  # this is the first stage
    into = fresh(docs, "__language")
    found = identify_documents(docs, docs, into=into).filter(F.col(into)["accepted"])
    return found.withColumn("lang", F.col(into)["lang"]).select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class, that with the smallest id."""
    return keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that are contaminated by ``benchmark``."""
    into = fresh(docs, "__contamination")
    judged = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), into=into)
    return judged.filter(~F.col(into)["contaminated"]).select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every secret in the text; ``n_chars`` is that of the masked text."""
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as mixed: one row per copy taken, numbered in ``copy_no``."""
    return repeat(docs)


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", dedup_stage),
    ("decontaminate", decontamination_stage),
    ("secret_scan", secret_stage),
    ("mixing", mixing_stage),
]

#: Signatures, likelihoods and automata have no SQL form; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
