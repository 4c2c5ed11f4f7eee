"""From raw documents to token files: the stages of a training corpus, one operator each.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. All but the
last return the columns of ``docs``: documents that the quality rules reject go, of near duplicates
one stays, documents with a benchmark passage go, and the mix repeats or leaves out documents by
their sources' targets. The last writes token files and returns what they hold, one row a document
(a repeated one as often as it was taken). Nulls, empty and repeated rows are treated as each
operator's docstring says; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarn.llm.decontamination import clean_documents
from tarn.llm.jobs import encoded
from tarn.llm.mixing import mixed_documents
from tarn.llm.quality import kept_documents
from tarn.llm.simhash import CONTRACT, DISTANCE, first_documents
from tarn.session import scratch_path
from tarn.sources.tables import read_table

#: The shingle hashes, the alignment and the tokenizer have no SQL; tests/llm holds the stages against plain code.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates as ``op8_simhash`` links them: shingles of three words, at most three differing bits."""
    return first_documents(docs, shingle=CONTRACT, distance=DISTANCE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(spark, docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each one's result written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
