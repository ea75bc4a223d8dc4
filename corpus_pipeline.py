"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

quality rules -> line dedup -> near-duplicates -> benchmark decontamination -> mixing.  The
last stage returns what the mix takes of each document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.decontaminate import drop_leaked
from martloom.llm.lines import drop_shared_lines
from martloom.llm.mixing import mix_sources
from martloom.llm.neardup import keep_one_each
from martloom.llm.quality import keep_good
from martloom.llm.texts import table
from martloom.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or any further rule go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in the first; ``n_chars`` follows the text."""
    kept = drop_shared_lines(docs).drop("n_lines", "n_dropped")
    return kept.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the smallest id."""
    return keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mix_sources(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near-duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixing)]

# The rules' verdicts, the groups and the tiles have no SQL form; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, the first on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{place}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
