"""The corpus pipeline: documents through five stages of ``pipewright.llm``.

``STAGES``: (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All stages but the last return the columns of documents.
``run`` writes each stage's result to the shared checkpoint folder and goes on
from the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.llm.common import documents, store
from pipewright.llm.decontaminate import apply_decontamination
from pipewright.llm.line_dedup import apply_line_dedup
from pipewright.llm.minhash_join import apply_near_dedup
from pipewright.llm.packing import pack
from pipewright.llm.quality_rules import apply_rules


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled rules keep."""
    return apply_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines repeated over documents."""
    return _recount(apply_line_dedup(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return apply_near_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that are mostly benchmark go."""
    return _recount(apply_decontamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placement of every kept document in bins."""
    return pack(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

ORACLE_SQL = None  # best-fit order and the automaton's spans are no SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
