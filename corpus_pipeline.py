"""The corpus pipeline: language ID, near duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and is
the next stage's docs. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from planact.llm import decontamination, language_id, packing, secret_scan, simhash
from planact.session import configure, stage


def spoken(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return language_id.accepted(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at three bits or fewer."""
    return simhash.first_of_each(docs)


def untested(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def discreet(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secret_scan.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in token sequences."""
    return packing.pack(docs)


def _configured(step):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return step(configure(spark), docs, sf_dir)

    return run


STAGES = [
    ("language_id", _configured(spoken)),
    ("near_duplicates", _configured(distinct)),
    ("decontamination", _configured(untested)),
    ("secrets", _configured(discreet)),
    ("packing", _configured(packed)),
]

#: Fingerprints, trained models and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
