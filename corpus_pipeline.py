"""Corpus pipeline: toxicity, line dedup, near-dedup, decontamination, mixing.

Every stage takes ``(spark, docs, sf_dir)``, where docs is what its predecessor kept, and returns
the documents that it keeps. ``run`` writes each stage's result as Parquet in the shared
folder and reads it again, so a lost executor costs at most a part of one stage.
"""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from feedward.llm.common import ensure_checkpoint_dir, read_table
from feedward.llm.decontaminate import drop_contaminated
from feedward.llm.lines import drop_repeated_lines
from feedward.llm.mixing import mix_sources
from feedward.llm.simhash import drop_near_duplicates
from feedward.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a random field trained on the labels does not call toxic."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that stand earlier; documents with nothing else go."""
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, with their place in it."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL cannot express the trained stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each on all that its predecessor kept."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
