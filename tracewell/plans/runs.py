"""Runs: all stages from pages to graph written under one folder, with a receipt for each stage, and read again for questions.

A run is a folder of Parquet tables, <folder>/runs/<run_id>/<table>; receipts are rows of <folder>/receipts, so the newest run is a query over them.
Nothing here opens a network connection.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.operators import answers, claims, corpus, entities, keyword, policy, retrieval, vectors
from tracewell.operators.stages import stored
from tracewell.sources import posts as page_sources
from tracewell.sources.pages import title

STAGES = ("crawl", "normalize", "index", "vector", "graph")
RECEIPT = "run_id string, stage string, profile string, at timestamp, rows long, network_touched boolean"
_SAFE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,127}")


def safe(run_id: str) -> str:
    """The id, if it may be the name of a folder."""
    if not _SAFE.fullmatch(run_id) or ".." in run_id:
        raise ValueError(f"not a run id: {run_id!r}")
    return run_id


def new_run_id(now: str, kind: str) -> str:
    """An id of a UTC time such as 2026-01-08T00:00:00Z and a kind."""
    return safe(re.sub("[-:]", "", now) + "__" + kind)


def normalized(pages: DataFrame) -> DataFrame:
    """Posts with entities of pages(page_id, url, html, captured_at); of a post that was captured more than once, the latest."""
    page = F.struct("url", F.col("captured_at").cast("string").alias("captured_at"), title(F.col("html")).alias("title"))
    found = page_sources.page_posts(pages.select(page.alias("page"), "html"), "page")
    rows = found.select(policy.topic_id(F.col("page.url")).alias("topic_id"), "post_id", "page.title", F.concat("page.url", F.lit("#entry"), "post_id").alias("source_url"), "author_label", "posted_at", "page.captured_at", "text", F.struct("page.url", "ord").alias("ord"))
    return entities.with_entities(corpus.latest(rows, ["topic_id", "post_id"], "captured_at", "ord"))


@dataclass(frozen=True)
class Run:
    run_id: str
    posts: DataFrame
    index: keyword.Index
    vectors: DataFrame
    claims: DataFrame
    nodes: DataFrame
    edges: DataFrame

    def search(self, queries: list[tuple[str, str]], k: int = 5) -> DataFrame:
        return keyword.search(self.index, keyword.analyse(self.posts.sparkSession, queries), k)

    def answer(self, queries: list[tuple[str, str]], k: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Reports, evidence chain and briefs of some questions."""
        q = keyword.analyse(self.posts.sparkSession, queries)
        specific, found = stored(keyword.specific_terms(self.index, q)), stored(keyword.search(self.index, q, k))
        found = found.join(F.broadcast(self.posts.select(F.col("source_url"), "entities")), "source_url") if "entities" not in found.columns else found
        context = stored(retrieval.context_edges(found, retrieval.edges_of(found, self.posts, self.claims)))
        entries = stored(answers.grounding(retrieval.rerank(found, context, retrieval.intents(q, specific)), context, answers.requests(q, specific)))
        chain = stored(answers.answer_texts(answers.evidence_chain(entries, context, self.claims)))
        report = answers.reports(entries, chain, context, answers.requests(q, specific).join(q.select("query_id", "query"), "query_id"))
        return report, chain, answers.briefs(report, chain)


def write(pages: DataFrame, folder: str, run_id: str, profile: str, at: str) -> str:
    """Writes all stages of a run, each from what the one before wrote, and their receipts; returns the run's folder."""
    spark, home = pages.sparkSession, f"{folder}/runs/{safe(run_id)}"
    rows: dict[str, int] = {"crawl": pages.count()}

    def table(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{home}/{name}")
        return spark.read.parquet(f"{home}/{name}")

    posts = table("posts", normalized(pages))
    rows["normalize"] = posts.count()
    index = keyword.build(posts.withColumn("key", F.concat_ws(":", "topic_id", "post_id")), "key")
    index.write(f"{home}/index")
    rows["index"] = index.docs.count()
    rows["vector"] = table("vectors", vectors.vectors(index.docs, "key", family="blake2b")).count()
    found = table("claims", claims.freshness_windows(claims.claims(posts, profile)))
    table("nodes", claims.merged_nodes(entities.graph_nodes(posts), claims.claim_nodes(found)))
    columns = ["kind", "from_node", "to_node", "source_url", "confidence"]
    own = entities.structural_edges(posts).select(*columns).unionByName(entities.relations(posts).select(*columns)).unionByName(claims.claim_edges(found).select(*columns))
    rows["graph"] = table("edges", own).count()
    done = spark.createDataFrame([(run_id, s, profile, rows[s], False) for s in STAGES], "run_id string, stage string, profile string, rows long, network_touched boolean")
    done.withColumn("at", F.lit(at).cast("timestamp")).select("run_id", "stage", "profile", "at", "rows", "network_touched").coalesce(1).write.mode("append").parquet(f"{folder}/receipts")
    return home


def receipts(spark: SparkSession, folder: str) -> DataFrame:
    """All receipts; none, if there is no folder yet."""
    try:
        return spark.read.schema(RECEIPT).parquet(f"{folder}/receipts")
    except Exception as e:  # the reader's error for a missing path has no class of its own
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], RECEIPT)


def read(spark: SparkSession, folder: str, run_id: str | None = None) -> Run:
    """A run whose stages all have a receipt, the newest one by default."""
    whole = receipts(spark, folder).groupBy("run_id").agg(F.countDistinct("stage").alias("n"), F.max("at").alias("at")).where(f"n = {len(STAGES)}")
    if run_id is not None:
        whole = whole.where(F.col("run_id") == safe(run_id))
    newest = whole.orderBy(F.col("at").desc(), F.col("run_id").desc()).first()
    if newest is None:
        raise LookupError("no run with the receipts of all stages")
    home = f"{folder}/runs/{newest['run_id']}"
    tables = {n: spark.read.parquet(f"{home}/{n}") for n in ("posts", "vectors", "claims", "nodes", "edges")}
    return Run(newest["run_id"], index=keyword.Index.read(spark, f"{home}/index"), **tables)


def export(packets: DataFrame, path: str) -> None:
    """One JSON object for each row, as text."""
    packets.select(F.to_json(F.struct(*packets.columns)).alias("value")).write.mode("overwrite").text(path)


def measured(spark: SparkSession, folder: str) -> DataFrame:
    """(files, bytes) below a folder, by its listing; no file is read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return listing.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
