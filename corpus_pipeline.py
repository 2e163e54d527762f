"""The corpus pipeline: documents through five of the training-data operators, one after the other.

Every stage reads whole texts and keeps or drops rows one by one: null text counts as empty, null and repeated
ids are no reason to drop a row, exact copies of a row share its fate in all stages but that of near copies, columns the
stage does not know pass through whatever their names, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from immunoframe.llm import bpe, decontaminate, ngram_join, quality, toxicity
from immunoframe.llm.common import drop_path, scratch_path, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep; texts of fewer than 50 words, empty ones among them, go."""
    return quality.keep_good(docs)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted toxic (a score below 0.5); empty texts stay."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: that with the least id, null ids last, then by a hash of the text.

    Of rows that repeat id and text one stays; texts without words link with nothing and all stay.
    """
    return ngram_join.one_of_each(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item; of rows that share an id each is judged by its own text."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token number and digests of each remaining document; an empty text has no tokens."""
    return bpe.digests(docs)


STAGES = [
    ("quality rules", quality_rules), ("toxicity", remove_toxic), ("n-gram Jaccard join", remove_near_copies),
    ("benchmark decontamination", remove_leaks), ("BPE encoding and decoding", tokens),
]

#: The covariance estimates, the learned lexicon and the merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
