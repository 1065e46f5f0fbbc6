"""Graph context of search results and reranking by relations that a query asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewell.operators import claims, entities

# Which words ask for which relations.
ROOT_TERMS = ["boot.img", "init_boot.img", "kernelsu", "ksu", "magisk", "root"]
RECOVERY_TERMS = ["orangefox", "recovery", "recovery.img", "twrp", "vendor_boot"]
ROOT_KINDS = ["method_targets_object", "method_uses_tool", "root_mentions_firmware", "root_targets_file", "root_uses_tool"]
RECOVERY_KINDS = ["method_targets_object", "method_uses_tool", "recovery_mentions_firmware", "recovery_targets_file", "recovery_uses_tool"]
PLAIN_TERMS = ["fastboot", "kernelsu", "ksu", "magisk", "orangefox", "recovery", "root", "twrp"]


def _plain(c: Column) -> Column:
    return F.translate(F.lower(c), "_-", "  ")


def intents(analysed: DataFrame, specific: DataFrame) -> DataFrame:
    """(query_id, root, recovery, values): the relations that a query asks for and the values that they should touch."""
    own = specific.groupBy("query_id").agg(F.collect_set("term").alias("s"))
    q = analysed.join(own, "query_id", "left").withColumn("s", F.coalesce("s", F.array().cast("array<string>")))
    said = F.concat("terms", "exact_terms", "technical_terms", "s")
    any_of = lambda t: F.arrays_overlap(said, F.array(*map(F.lit, t)))
    plain = F.filter(F.transform("terms", _plain), lambda x: x.isin(PLAIN_TERMS))
    values = F.array_distinct(F.filter(F.concat(F.transform(F.concat("exact_terms", "s", "technical_terms"), _plain), plain), lambda x: F.length(x) >= 3))
    return q.select("query_id", any_of(ROOT_TERMS).alias("root"), any_of(RECOVERY_TERMS).alias("recovery"), values.alias("values"))


def edges_of(results: DataFrame, posts: DataFrame, found: DataFrame, across: bool = True) -> DataFrame:
    """(source_url, kind, from_node, to_node, confidence): every relation that names the address of a result, once for each address.

    posts have entities, found are their claims. Of relations between claims only those with a claim of a result are made: the results are
    the side that is broadcast, so the work grows with the claims and not with their square. Where nobody asks which claims are related, across=False
    gives each sort of relation between claims once for an address, with nodes that name no claim.
    """
    columns = ["source_url", "kind", "from_node", "to_node", "confidence"]
    asked = F.broadcast(results.select("source_url").distinct())
    if across:
        between = claims.cross_edges(found, asked).withColumn("source_url", F.explode("source_urls")).join(asked, "source_url", "left_semi")
    else:
        between = claims.cross_kinds(found, asked).withColumns({c: F.lit("claim:") for c in ("from_node", "to_node")})
    own = entities.relations(posts.join(asked, "source_url", "left_semi")).select(*columns).unionByName(claims.claim_edges(found.join(asked, "source_url", "left_semi")).select(*columns))
    return own.unionByName(between.select(*columns))


def context_edges(results: DataFrame, edges: DataFrame) -> DataFrame:
    """The relation edges of each result's own post: (query_id, key, kind, from_node, to_node, confidence).

    A post's edges all name its address, so the address is the key of the join; what edges start from or go to decides the rest.
    """
    near = F.col("from_node").startswith("entity:") | F.col("from_node").startswith("claim:") | F.col("to_node").startswith("claim:") | F.col("from_node").startswith("post:")
    wanted = edges.where(near & ~F.col("kind").isin("post_mentions_entity", "topic_contains_post"))
    return F.broadcast(results.select("query_id", "key", "source_url")).join(wanted.select("source_url", "kind", "from_node", "to_node", "confidence"), "source_url").drop("source_url")


def rerank(results: DataFrame, context: DataFrame, wanted: DataFrame) -> DataFrame:
    """Results with matching_edge_count, matching_kinds, matching_confidence and graph_rank; queries without an intent keep their order."""
    c = context.join(F.broadcast(wanted), "query_id")
    kind = F.col("kind")
    desired = (F.col("root") & kind.isin(ROOT_KINDS)) | (F.col("recovery") & kind.isin(RECOVERY_KINDS))
    to_only = kind.rlike("_(uses_tool|targets_file|targets_object|mentions_firmware)$")
    said = _plain(F.when(to_only, F.col("to_node")).otherwise(F.concat_ws(" ", "kind", "from_node", "to_node")))
    matching = c.where(desired & ((F.size("values") == 0) | F.exists("values", lambda v: F.contains(said, v))))
    counted = matching.groupBy("query_id", "key").agg(F.count("*").alias("matching_edge_count"), F.countDistinct("kind").alias("matching_kinds"), F.round(F.sum("confidence"), 6).alias("matching_confidence"))
    out = results.join(counted, ["query_id", "key"], "left").fillna({"matching_edge_count": 0, "matching_kinds": 0, "matching_confidence": 0.0}).join(F.broadcast(wanted.select("query_id", (F.col("root") | F.col("recovery")).alias("_asked"))), "query_id")
    keys = [F.when(F.col("_asked"), x) for x in (F.col("matching_edge_count"), F.col("matching_kinds"), F.col("matching_confidence"), F.size("matched_specific_terms"), F.size("matched_exact_terms"), F.col("score"))]
    out = out.withColumn("graph_rank", F.row_number().over(W.partitionBy("query_id").orderBy(*[k.desc() for k in keys], "rank"))).withColumnRenamed("_asked", "asked_relations")
    share = lambda n: F.least(F.col(n), F.lit(2)) / 2
    raw = 0.4 * share("matching_edge_count") + 0.4 * share("matching_kinds") + 0.2 * F.least("matching_confidence", F.lit(1.0))
    return out.withColumn("graph_raw", F.when(F.col("matching_edge_count") > 0, F.round(raw, 6)).otherwise(0.0))
