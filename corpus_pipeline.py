"""From raw documents to token ids: quality, repeated lines, near-duplicates, benchmark passages, BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. run() chains them; a runner may also write each result and hand it to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, decontaminate, line_dedup, quality_classifier, simhash
from millrace.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts; it is fitted on the labelled documents of sf_dir."""
    return quality_classifier.keep_good(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines seen earlier; a document that loses all its lines goes."""
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each_group(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_words, n_tokens, token_ids, round_trip)"""
    return bpe.encode_corpus(docs)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("SimHash near-dedup", near_duplicates), ("benchmark decontamination", benchmark), ("BPE encoding", tokens)]

#: Stages 1, 3 and 5 are not expressible in SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; each result before it is written once and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
