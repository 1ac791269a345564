"""A training corpus from raw documents: quality classifier, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns a DataFrame; all but the
last return the columns of ``docs``. Stages keep null ids and texts, repeated rows and further columns as their operators
say; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nickmap.llm.common import table, written
from nickmap.llm.line_dedup import dedup_lines
from nickmap.llm.mixing import mix_documents
from nickmap.llm.packing import pack_documents
from nickmap.llm.quality import fit_quality, keep_quality
from nickmap.llm.simhash import keep_one
from nickmap.llm.tokens import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is fitted on the labels of ``docs``."""
    return keep_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one."""
    return dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: SimHash of five-word shingles, links held to a similarity of 0.8."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), 2)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: SQL can't fit the classifier, nor follow the links of near-duplicates; the tests hold run() to a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
