"""From raw documents to a training mixture, in five stages.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. ``run`` writes what each
returns as Parquet and hands it, read again, to the next. All but the last return the
columns they got. Edge cases are those of the operators that a stage calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airway.llm.decontamination import without_contaminated
from airway.llm.mixing import mix_sources
from airway.llm.near_dedup import without_near_duplicates
from airway.llm.quality_model import good_documents
from airway.llm.secret_scan import redact
from airway.sources.staging import session_work


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near copies."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and lengths counted anew."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target shares of their sources, in random order."""
    return mix_sources(docs)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixing),
]

# SQL cannot express the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = session_work(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
