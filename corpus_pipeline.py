"""A corpus pipeline over ``documents``: each stage works on all that its predecessor kept.

1. quality rules: documents that break them go;
2. line dedup: lines on many sites are cut out of the texts;
3. n-gram Jaccard join: of each group of near copies one document stays;
4. benchmark decontamination: documents with a benchmark passage go;
5. SentencePiece: the rest becomes token ids.

All stages but the last return the columns of ``documents``. A row without text breaks the quality rules;
empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesync.llm import decontaminate, jaccard, line_dedup, pieces, quality
from tablesync.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("SentencePiece", encode),
]

#: SQL expresses neither the search with edits nor the segmentation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of the documents that are kept; every stage but the last is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
