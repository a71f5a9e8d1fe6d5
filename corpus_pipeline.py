"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

language ID (documents without a tellable language go), exact dedup, n-gram
Jaccard join (one document of each group stays), mixing sources to target
weights (a document is repeated or left out as its source's budget says),
best-fit packing (the pieces of the mix with their sequences).

Every stage works on all that its predecessor kept; all but the last return
the columns of their input.  An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendscope.llm import exact_dedup, langid, mixing, ngram_join, packing
from spendscope.llm.common import Scratch
from spendscope.llm.queries import read, remainder, tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.of_known_language(docs, remainder("doc_id", 4) != 2)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", dedup),
    ("ngram_jaccard_join", near_dedup),
    ("source_mixing", mix),
    ("best_fit_packing", pack),
]

#: Trained models and token ids are beyond SQL; tests/llm holds the stages against plain Python on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the whole table."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
