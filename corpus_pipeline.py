"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, then tokens.

Each stage reads what the one before has written and calls one operator of relist.llm; all but the last
return the columns of its documents. The filters judge every row by its text alone;
the dedup stages leave one row of each group, that with the smallest doc_id, whether ids repeat or are missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relist.llm import decontaminate, exact, quality, sentencepieces, simhash
from relist.llm.common import table
from relist.session import materialize


def quality_ranking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is under the threshold go."""
    labels = table(spark, sf_dir, "labels").where(quality.learnable())
    return quality.drop_refused(docs, quality.train(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id stays; null counts as empty."""
    return exact.drop_exact_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) of the documents that are left."""
    return sentencepieces.encode(docs).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality_ranking", quality_ranking),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_tokens", sentencepiece_tokens),
]

#: The ranking and the tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`, each on what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
