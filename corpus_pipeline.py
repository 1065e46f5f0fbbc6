"""A corpus pipeline: quality classifier, line dedup, n-gram Jaccard join, best-fit packing.

Each stage gets a table with the columns of ``documents`` and all but the last return one; ``run`` writes each result to the shared
checkpoint folder before the next stage reads it. Rows are told apart by id and text, so ids may repeat and be null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import line_dedup, ngram_join, quality
from tracewell.llm.queries import pack_documents
from tracewell.llm.spark_util import cut, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose score is under the threshold."""
    docs = docs.select(*COLUMNS)
    scored = quality.add_score(docs, quality.train(docs, table(spark, sf_dir, "labels")), "_score")
    return scored.where(F.col("_score") >= quality.THRESHOLD).select(*COLUMNS)


def line_templates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the lines of recurring templates, and the documents of which nothing is left."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS)).where("n_dropped = 0 OR trim(text) <> ''")
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each linked group, that with the smallest id; documents without words link with nothing and stay."""
    return ngram_join.without_duplicates(docs.select(*COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document with their places in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_templates),
    ("ngram_jaccard_join", ngram_jaccard),
    ("best_fit_packing", best_fit_packing),
]

#: The fitted rules, hashed templates and token ids have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
