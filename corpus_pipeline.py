"""A training corpus from the documents table, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import decontaminate, mixing, near_dup, quality_model, token_files
from quillon.llm.text import table
from quillon.session import materialise


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null and empty texts are scored by the statistics of the empty text; a null
    doc_id is scored like others. Repeated rows get the same verdict. Without
    labels of both kinds all documents have one score. An empty table gives none.
    """
    return quality_model.good_documents(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more.

    The smallest doc_id of a group stays, with all rows that repeat it. Documents
    without words or without a doc_id are like no other and stay.
    """
    return near_dup.first_of_each(docs, n=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't contain a benchmark item's shingles to 80 % or more.

    Null and empty texts contain nothing; rows that repeat a doc_id count as one
    text; a null doc_id stays. An empty benchmark takes no document out.
    """
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, three times at most.

    A null source is a source of its own. Documents without words are taken
    nowhere; rows that repeat a doc_id, source and size are taken alike.
    """
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; what they hold of each document.

    A null or empty text is the end id alone; null doc_ids come first, and rows
    that repeat a doc_id are written one after the other.
    """
    return token_files.tokenise(docs)


STAGES = [
    ("quality classifier", classify),
    ("MinHash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", tokens),
]

#: SQL can express neither the classifier nor the sketches nor the vocabulary; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
