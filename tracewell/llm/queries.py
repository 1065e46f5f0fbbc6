"""Queries of this subpackage: (spark, folder of the tables) -> DataFrame, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import bpe, chat, html_crf, license_scan, line_dedup, media, near_vectors, ngram_join, packing, quality
from tracewell.llm.spark_util import table

def pack_documents(docs: DataFrame) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, bpe.vocabulary()))


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_messages(table(spark, sf_dir, "conversations"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.vocabulary())


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.add_score(docs, model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no paths; a document counts as <source>/<lang>/<doc_id>.txt."""
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs.select("doc_id", F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"), "text"))


def op10_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(table(spark, sf_dir, "documents"), lpc_order=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_vectors": op1_near_vectors,
    "op2_html_main_text": op2_html_main_text,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_quotation_links": op5_quotation_links,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op7_line_templates": op7_line_templates,
    "op8_quality_rules": op8_quality_rules,
    "op9_license_scan": op9_license_scan,
    "op10_flac_media": op10_flac_media,
}
SQL: dict[str, str] = {}
