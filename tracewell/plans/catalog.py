"""Queries of the engine by name, with DuckDB SQL of the same rows where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions import rules as R
from tracewell.functions import text as T
from tracewell.operators import answers, audits, claims, corpus, entities, keyword, policy, readiness as readiness_ops, registry, retrieval, suites, vectors
from tracewell.operators.stages import once, spread, stored
from tracewell.sources import pages as sources
from tracewell.sources import posts

#: Queries of the catalogue's searches, and its clock.
ASKED = [
    ("q1", "Redmi Note 10 Pro bootloop boot.img V14.0.7.0"),
    ("q2", "flash recovery.img with fastboot after update HyperOS 2.0.5"),
    ("q3", "the of and that thing"),
    ("q4", "do not install recovery.img Xiaomi 13T aristotle"),
    ("q5", "Magisk root boot.img MIUI 2306EPN60G"),
    ("q6", "Licensed under the Apache License, Version 2.0."),
]
NOW = "2026-01-08T00:00:00Z"
TERMS = ["en/4", "the"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _posts(spark: SparkSession, sf_dir: str, decorated: bool = True) -> DataFrame:
    docs = spread(_table(spark, sf_dir, "documents"))
    return corpus.posts_from_documents(corpus.decorate(docs) if decorated else docs)


def _index(spark: SparkSession, sf_dir: str) -> keyword.Index:
    return keyword.build(_posts(spark, sf_dir))


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of queries that read the tokens once."""
    return keyword.tokenised(_posts(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyword_search(spark, sf_dir)


def token_counts(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    docs = once(spread(_table(spark, sf_dir, "documents")).select("doc_id", T.aliases(text).alias("a"), text.alias("text")), "t", T.tokens(F.col("text")))
    return docs.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.size(T.exact_terms(F.col("t"))).cast("long").alias("n_exact"), F.size("a").cast("long").alias("n_aliases"))


def technical_aliases(spark, sf_dir):
    return _posts(spark, sf_dir).select("post_id", F.array_join(F.array_sort(T.aliases(F.col("text"))), ",").alias("aliases"))


def term_stats(spark, sf_dir):
    return _index(spark, sf_dir).postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def corpus_stats(spark, sf_dir):
    index = _index(spark, sf_dir)
    return index.corpus.select("doc_count", F.round("avg_len", 6).alias("avg_len")).crossJoin(index.terms.agg(F.count("*").alias("term_count"))).crossJoin(index.exact.agg(F.count("*").alias("exact_postings")))


def exact_terms(spark, sf_dir):
    return _index(spark, sf_dir).exact.groupBy("term").agg(F.count("*").alias("df"), F.min("key").alias("first_key"))


def query_terms(spark, sf_dir):
    q = keyword.analyse(spark, ASKED)
    join = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), "|").alias(c)
    return q.select("query_id", keyword.packet_id(F.col("query")).alias("packet_id"), *map(join, ["terms", "exact_terms", "phrases"]))


def specific_terms(spark, sf_dir):
    return keyword.specific_terms(_index(spark, sf_dir), keyword.analyse(spark, ASKED))


def keyword_search(spark, sf_dir, k: int = 10):
    found = keyword.search(_index(spark, sf_dir), keyword.analyse(spark, ASKED), k)
    return found.select("query_id", "rank", "key", "score", "bm25", "exact", "phrase", F.array_join("matched_specific_terms", "|").alias("specific"), "snippet")


def hashed_vectors(spark, sf_dir):
    v = vectors.vectors(_tokens(spark, sf_dir), "key")
    return v.groupBy("bucket").agg(F.count("*").alias("docs"), F.round(F.sum(F.abs("w")), 6).alias("weight"), F.max("w").alias("top"))


def blake_vectors(spark, sf_dir):
    return vectors.vectors(_tokens(spark, sf_dir), "key", family="blake2b")


def vector_search(spark, sf_dir, k: int = 10):
    return vectors.search_tokens(_tokens(spark, sf_dir), keyword.analyse(spark, ASKED), k)


def hybrid_search(spark, sf_dir, k: int = 10):
    index, q = _index(spark, sf_dir), keyword.analyse(spark, ASKED)
    arm = max(4 * k, 80)  # candidates of each arm
    both = vectors.hybrid(keyword.search(index, q, arm), vectors.search_tokens(index.docs, q, arm), k)
    return both.select("query_id", "rank", "key", "score", "keyword_rank", "vector_rank")


def chunks(spark, sf_dir):
    return corpus.chunks(_posts(spark, sf_dir)).select("chunk_id", "post_id", "chunk_index", "char_start", "char_end", "text")


def chunk_search(spark, sf_dir, k: int = 5):
    units = corpus.chunks(_posts(spark, sf_dir)).withColumn("ord", F.struct("ord", "chunk_index"))
    found = keyword.search(keyword.build(units, "chunk_id"), keyword.analyse(spark, ASKED), k)
    return found.select("query_id", "rank", "key", "post_id", "char_start", "char_end", "score", "snippet")


def entity_mentions(spark, sf_dir):
    found = entities.mentions(entities.with_entities(_posts(spark, sf_dir)))
    return found.groupBy("kind", "value").agg(F.count("*").alias("posts"), F.min("post_id").alias("first_post"))


def relation_edges(spark, sf_dir):
    found = entities.relations(entities.with_entities(_posts(spark, sf_dir)))
    return found.select("edge_id", "kind", "from_node", "to_node", "post_id", "confidence")


def graph_nodes(spark, sf_dir):
    found = entities.graph_node_counts(stored(entities.with_entities(_posts(spark, sf_dir))))
    return found.select("node_id", "kind", "label", "refs", "confidence")


def graph_edges(spark, sf_dir):
    return entities.structural_edges(entities.with_entities(_posts(spark, sf_dir))).groupBy("kind", "confidence").agg(F.count("*").alias("edges"), F.countDistinct("edge_id").alias("distinct_edges"))


def _claims(spark, sf_dir):
    return stored(claims.claims(entities.with_entities(_posts(spark, sf_dir))))


def claim_rows(spark, sf_dir):
    rows = claims.freshness_windows(_claims(spark, sf_dir))
    joined = [F.array_join(c, "|").alias(c) for c in ("target_labels", "tool_labels", "condition_labels", "applicability_context", "risk_labels", "warning_labels")]
    return rows.select("claim_id", "claim_kind", "method_id", "action", "label", *joined, "post_id", "confidence", "manual_review_required", "relation_key", "profile_window", "newer_related_count", "evidence_start")


def claim_kinds(spark, sf_dir):
    rows = _claims(spark, sf_dir)
    return rows.groupBy("claim_kind", "method_kind", "action", "confidence").agg(F.count("*").alias("n"), F.count_if("manual_review_required").alias("manual"))


def claim_edges(spark, sf_dir):
    return claims.claim_edges(_claims(spark, sf_dir)).groupBy("kind").agg(F.count("*").alias("edges"), F.round(F.sum("confidence"), 4).alias("confidence"))


def claim_cross_edges(spark, sf_dir):
    return claims.cross_edge_counts(_claims(spark, sf_dir)).groupBy("kind", "confidence", "manual_review_required").agg(F.sum("edges").alias("edges"), F.min("claim_id").alias("first"))


def claim_stats(spark, sf_dir):
    rows = _claims(spark, sf_dir)
    edges = claims.claim_edges(rows).groupBy("kind").agg(F.count("*").alias("edges")).unionByName(claims.cross_edge_counts(rows).groupBy("kind").agg(F.sum("edges").alias("edges")))
    return claims.claim_stats(rows, edges)


def suite_checks(spark, sf_dir):
    """Expectations over the results of keyword search; a case without a query fails its checks."""
    found = keyword.search(_index(spark, sf_dir), keyword.analyse(spark, ASKED), 10)
    seen = suites.facts(found, "query_id", {"key": F.col("key"), "terms": F.col("matched_terms"), "exact": F.col("matched_exact_terms"), "score": F.col("score"), "rank": F.col("rank")})
    rows = [(c, f"{c}-{n}", field, op, expected) for c in ("q1", "q2", "q4", "q6", "q9") for n, (field, op, expected) in enumerate([("terms", "all", ["boot.img", "bootloop"]), ("exact", "contains", ["IMG"]), ("terms", "prefix", ["flash", "lic"]), ("score", "minimum", ["20"]), ("rank", "at_most", ["1"]), ("exact", "absent", ["recovery.img"]), ("key", "equal", None)])]
    return suites.evaluate(spark.createDataFrame(rows, "case_id string, check_id string, field string, op string, expected array<string>"), seen)


def _ranked(spark, sf_dir, k: int = 10, across: bool = False):
    """Reranked results of the catalogue's queries, their context, what was asked, and all claims."""
    posts = stored(entities.with_entities(_posts(spark, sf_dir)))
    index, q = keyword.build(posts), keyword.analyse(spark, ASKED)
    specific = stored(keyword.specific_terms(index, q))
    found = stored(keyword.search(index, q, k))
    rows = stored(claims.claims(posts))
    context = stored(retrieval.context_edges(found, retrieval.edges_of(found, posts, rows, across)))
    return retrieval.rerank(found, context, retrieval.intents(q, specific)), context, answers.requests(q, specific).join(q.select("query_id", "query"), "query_id"), rows


def graph_search(spark, sf_dir, k: int = 10):
    return _ranked(spark, sf_dir, k)[0].select("query_id", "graph_rank", "rank", "key", "score", "matching_edge_count", "matching_kinds", "matching_confidence", "graph_raw")


def graph_hybrid_search(spark, sf_dir, k: int = 10):
    posts = stored(entities.with_entities(_posts(spark, sf_dir)))
    index, q, arm = keyword.build(posts), keyword.analyse(spark, ASKED), max(4 * k, 80)
    found = stored(keyword.search(index, q, arm))
    context = stored(retrieval.context_edges(found, retrieval.edges_of(found, posts, stored(claims.claims(posts)), across=False)))
    ranked = retrieval.rerank(found, context, retrieval.intents(q, keyword.specific_terms(index, q))).drop("rank").withColumnRenamed("graph_rank", "rank")
    both = vectors.hybrid(ranked, vectors.search_tokens(index.docs, q, arm), k, "graph_raw")
    return both.select("query_id", "rank", "key", "score", "keyword_rank", "vector_rank", "graph_normalized")


def _entries(spark, sf_dir, k: int = 10, across: bool = False):
    ranked, context, asked, rows = _ranked(spark, sf_dir, k, across)
    return stored(answers.grounding(ranked, context, asked)), context, asked, rows


def _chain(spark, sf_dir, across: bool = False):
    entries, context, asked, rows = _entries(spark, sf_dir, across=across)
    return entries, stored(answers.answer_texts(answers.evidence_chain(entries, context, claims.freshness_windows(rows)))), context, asked


def grounding(spark, sf_dir):
    return _entries(spark, sf_dir)[0].select("query_id", "graph_rank", "key", "matched_count", "unmatched_structured", "relation_supported", "warning_requested", "warning_supported", "grounded")


def evidence_chain(spark, sf_dir):
    return _chain(spark, sf_dir)[1].select("query_id", "step", "post_id", "role", "answer_kind", F.array_join("relation_kinds", "|").alias("relation_kinds"))


def answer_labels(spark, sf_dir):
    joined = lambda c: F.array_join(c, "|").alias(c)
    names = ["issue_labels", "fix_labels", "warning_labels", "warned_target_labels", "root_action_labels", "recovery_action_labels", "target_file_labels", "tool_labels", "firmware_context_labels", "claim_ids", "claim_context_labels", "claim_condition_labels", "windows"]
    return _chain(spark, sf_dir)[1].select("query_id", "step", "post_id", "answer_text", "min_confidence", *map(joined, names))


def conflict_report(spark, sf_dir):
    entries, chain, _, _ = _chain(spark, sf_dir)
    return answers.conflict_report(entries, chain)


def conflict_claims(spark, sf_dir):
    _, chain, context, _ = _chain(spark, sf_dir, across=True)
    return answers.conflict_claims(chain, context).groupBy("query_id", "role").agg(F.count("*").alias("claims"), F.min("claim_id").alias("first_claim"))


def answer_reports(spark, sf_dir):
    entries, chain, context, asked = _chain(spark, sf_dir)
    joined = lambda c: F.array_join(c, "|").alias(c)
    out = answers.reports(entries, chain, context, asked)
    return out.select("query_id", "chain_step_count", "topic_count", "source_count", "filtered_count", "deduplicated_count", "freshness_state", "applicability_status", "warning_requested", "warning_supported", "risk_status", "warning_relation_count", "confidence", "latest_captured_at", *map(joined, ["answer_kinds", "relation_kinds", "profile_windows", "context_labels", "condition_labels", "warning_labels", "warning_target_labels"]))


def answer_briefs(spark, sf_dir):
    entries, chain, context, asked = _chain(spark, sf_dir)
    return answers.briefs(answers.reports(entries, chain, context, asked), chain)


def claim_nodes(spark, sf_dir):
    return claims.claim_node_counts(_claims(spark, sf_dir)).select("node_id", "kind", "label", "refs", "confidence")


def merged_nodes(spark, sf_dir):
    posts = stored(entities.with_entities(_posts(spark, sf_dir)))
    both = claims.merged_nodes(entities.graph_nodes(posts), claims.claim_nodes(claims.claims(posts)))
    return both.groupBy("kind").agg(F.count("*").alias("nodes"), F.sum(F.size("source_refs")).alias("refs"), F.round(F.sum("confidence"), 4).alias("confidence"))


#: Pages in the four layouts, made of documents: a number, a name, a time and the text of each.
def _laid_out(spark, sf_dir):
    docs = spread(_table(spark, sf_dir, "documents")).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("source", F.lit("")).alias("source"))
    body = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    shapes = {
        0: '<html><body><h1>{s}</h1><table class="t" data-post="{i}"><tr><td id="ph-{i}-d1"><div id="post-member-{i}"><span class="normalname"><a href="/u">by {s}</a></span></div></td><td id="ph-{i}-d2"><div>no</div><img src="x"> 01.02.21, 10:30<span id="kh-{i}"></span></td></tr><tr><td class="post2" id="post-main-{i}"><div>{t}<div class="post-block quote">old words</div><span class="edit">edited</span></div></td></tr><tr id="pb-{i}-r3"><td>foot</td></tr></table></body></html>',
        1: '<html><body><div class="x post_body y" id="post-main-{i}">{t}<script>var a;</script></div></div></body></html>',
        2: "<html><body><article class='c' id='post-{i}'>{t}</article><p>none</p></body></html>",
        3: '<html><body><p id="post-main-{i}">{t}</p><div class="signature">me</div></body></html>',
    }
    values = {"i": F.col("doc_id").cast("string"), "s": F.col("source"), "t": body}

    def filled(shape: str):
        parts = re.split(r"\{([ist])\}", shape)
        return F.concat(*[values[p] if n % 2 else F.lit(p) for n, p in enumerate(parts)])

    html = F.when(F.col("doc_id") % 4 == 0, filled(shapes[0])).when(F.col("doc_id") % 4 == 1, filled(shapes[1])).when(F.col("doc_id") % 4 == 2, filled(shapes[2])).otherwise(filled(shapes[3]))
    return docs.select(F.col("doc_id").alias("page_id"), html.alias("html"))


def page_posts(spark, sf_dir):
    return posts.page_posts(_laid_out(spark, sf_dir))


def decoded_pages(spark, sf_dir):
    """Every other text as bytes of windows-1251 where that can hold it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cyrillic = F.concat(F.lit("\xcf\xf0\xee\xf8\xe8\xe2\xea\xe0 "), F.regexp_replace("text", "[^\\x00-\\x7F]", "?"))
    content = F.when(F.col("doc_id") % 2 == 0, F.encode(F.concat(F.lit("Прошивка "), "text"), "UTF-8")).otherwise(F.encode(cyrillic, "ISO-8859-1"))
    out = posts.decode_pages(docs.select("doc_id", content.alias("content")), "doc_id")
    return out.select("doc_id", F.sha2("html", 256).alias("sha256"), F.length("html").cast("long").alias("n_chars"))


def _urls(spark, sf_dir):
    """Page addresses, and topic addresses made of page ids."""
    p = _table(spark, sf_dir, "pages")
    base = F.when(F.col("page_id") % 4 == 0, "http://").otherwise("https://")
    host = F.when(F.col("page_id") % 5 == 0, "www.forum.example.org").otherwise("forum.example.org")
    tail = F.when(F.col("page_id") % 6 == 0, "&act=search").when(F.col("page_id") % 6 == 1, "&st=").when(F.col("page_id") % 6 == 2, "#entry5").otherwise(F.concat(F.lit("&st="), (F.col("page_id") % 3 * 20).cast("string")))
    topic = F.concat(base, host, F.lit("/index.php?showtopic="), (F.col("page_id") % 50).cast("string"), tail)
    return p.select("page_id", "url").unionByName(p.select("page_id", topic.alias("url")))


def url_policy(spark, sf_dir):
    u = F.col("url")
    return _urls(spark, sf_dir).select("page_id", "url", policy.allowed(u).alias("allowed"), F.when(policy.allowed(u), policy.canonical(u)).alias("canonical"), policy.topic_id(u).alias("topic_id"), policy.page_start(u).alias("page_start"))


def page_titles(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", sources.title(F.col("html")).alias("title"))


def page_links(spark, sf_dir):
    return sources.links(_table(spark, sf_dir, "pages"))


def page_texts(spark, sf_dir):
    return sources.texts(_table(spark, sf_dir, "pages"))


def _seeds(spark):
    rows = [(i, f"s{i}", f"https://forum.example.org/index.php?showtopic={3 * i}&st={20 * (i % 3)}", f"f{i % 4}", i % 3 + 1) for i in range(10)]
    return spark.createDataFrame(rows, "seed_ord int, seed_id string, url string, focus string, max_pages int")


def _links(spark, sf_dir):
    u = _urls(spark, sf_dir).where("url LIKE '%showtopic%'")
    return u.select(F.concat(F.lit("https://forum.example.org/index.php?showtopic="), (F.col("page_id") % 9).cast("string")).alias("source_url"), F.concat(F.lit("label "), (F.col("page_id") % 4).cast("string")).alias("source_label"), F.col("page_id").alias("ord"), "url", F.concat(F.lit("topic "), (F.col("page_id") % 50).cast("string")).alias("anchor_text"))


def _candidates(spark, sf_dir):
    return audits.candidates(_links(spark, sf_dir), _seeds(spark), ["topic 7", "label 3"])


def discovery_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir).withColumn("anchor_texts", F.array_join("anchor_texts", "|"))


def seed_review(spark, sf_dir):
    decisions = spark.createDataFrame([("https://forum.example.org/index.php?showtopic=7&st=20", "accept")], "url string, decision string")
    rules = spark.createDataFrame([(0, "seed_topic_new_window", None, 3, "expand"), (1, None, "11", None, "reject"), (2, "unseeded_topic", None, 2, "watch")], "rule_ord int, candidate_kind string, topic_id string, min_source_count int, decision string")
    return audits.review(_candidates(spark, sf_dir), decisions, rules).select("url", "candidate_kind", "source_count", "decision")


def review_state(spark, sf_dir):
    decisions = spark.createDataFrame([("https://forum.example.org/index.php?showtopic=7&st=20", "accept"), ("https://forum.example.org/index.php?showtopic=999&st=0", "reject")], "url string, decision string")
    rules = spark.createDataFrame([(0, "seed_topic_new_window", None, 3, "accept"), (1, None, "11", None, "reject")], "rule_ord int, candidate_kind string, topic_id string, min_source_count int, decision string")
    found = stored(_candidates(spark, sf_dir))
    return audits.review_summary(audits.review(found, decisions, rules), audits.stale_decisions(decisions, found, _seeds(spark)), _seeds(spark))


def review_order(spark, sf_dir):
    return audits.review_order(_candidates(spark, sf_dir), 40).select("place", "url", "review_priority", "candidate_kind", "source_count")


def link_counts(spark, sf_dir):
    return audits.link_counts(_urls(spark, sf_dir))


def coverage_summary(spark, sf_dir):
    return audits.coverage_summary(_seeds(spark), policy.crawl_plan(_seeds(spark), 8), _fetched(spark, sf_dir))


def refresh_checks(spark, sf_dir):
    receipts = _receipts(spark, sf_dir).withColumns({"errors": (F.col("event_id") % 7 == 0).cast("int"), "network_touched": F.col("event_id") % 11 == 0})
    return audits.refresh_checks(receipts, receipts.agg(F.max("at").alias("now")), 168.0)


def source_upsert(spark, sf_dir):
    """A registry of the customers' segments, and upserts of every third customer."""
    c = _table(spark, sf_dir, "customer").withColumns({"ref": F.concat(F.lit("https://forum.example.org/index.php?showtopic="), (F.col("c_custkey") % 40).cast("string")), "kind": F.when(F.col("c_custkey") % 3 == 0, "topic").otherwise("forum")})
    old = c.where("c_custkey % 2 = 0").groupBy("ref", "kind").agg(F.min("c_custkey").alias("n"))
    old = old.select(policy.source_id(F.col("kind"), F.col("ref")).alias("source_id"), F.col("ref").alias("source_ref"), "kind", F.lit("public").alias("access"), F.concat(F.lit("old "), F.col("n").cast("string")).alias("title"), F.lit("s").alias("scope"), F.array(F.lit("kept")).alias("tags"), F.lit(0.5).alias("trust_score"), F.lit(True).alias("enabled"), F.lit("none").alias("include_media"), F.lit("2025-01-01").alias("created_at"), F.lit("2025-01-01").alias("updated_at"))
    new = c.where("c_custkey % 5 = 0").select(F.col("ref").alias("source_ref"), "kind", F.lit(None).cast("string").alias("access"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("title"), F.lit(None).cast("string").alias("scope"), F.when(F.col("c_custkey") % 3 == 0, F.array(F.col("c_mktsegment"), F.lit(" Two  Words "))).otherwise(F.array().cast("array<string>")).alias("tags"), F.when(F.col("c_custkey") % 4 == 0, F.lit(0.75)).alias("trust_score"), F.lit(None).cast("boolean").alias("enabled"), F.lit(None).cast("string").alias("include_media"), F.col("c_custkey").alias("ord"))
    return registry.upsert(old, new, F.lit(NOW)).withColumn("tags", F.array_join("tags", "|"))


def source_errors(spark, sf_dir):
    given = _table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 50 == 0, F.lit(" ")).otherwise(F.col("c_name")).alias("source_ref"), F.when(F.col("c_custkey") % 7 == 0, "blog").otherwise("topic").alias("kind"), F.when(F.col("c_custkey") % 11 == 0, "login").alias("access"), F.when(F.col("c_custkey") % 13 == 0, "video").alias("include_media"), (F.col("c_acctbal") / 10000).alias("trust_score"))
    return registry.errors(given)


def crawl_plan(spark, sf_dir):
    return policy.crawl_plan(_seeds(spark), 8)


def _fetched(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("s"), (F.col("user_id") % 9).cast("string")).alias("seed_id"), (F.col("event_id") % 3 * 20).cast("string").alias("page_start"))


def coverage(spark, sf_dir):
    return audits.coverage(policy.crawl_plan(_seeds(spark), 8), _fetched(spark, sf_dir))


def missing_pages(spark, sf_dir):
    return audits.missing_pages(policy.crawl_plan(_seeds(spark), 8), _fetched(spark, sf_dir))


def _needs(spark):
    return spark.createDataFrame([("n1", ["f0"], ["a"]), ("n2", ["f9"], ["a"]), ("n3", ["f0", "f1"], []), ("n4", ["f1"], ["a", "z"]), ("n5", ["f3"], ["b"])], "need_id string, seed_focus_any array<string>, eval_cases array<string>")


def need_coverage(spark, sf_dir):
    return audits.needs(_needs(spark), _seeds(spark), _fetched(spark, sf_dir))


def route_ratio(spark, sf_dir):
    return audits.route_ratio(_needs(spark), spark.createDataFrame([("a",), ("b",)], "case_id string"))


def _receipts(spark, sf_dir):
    stage = F.element_at(F.array(*map(F.lit, ["crawl", "normalize", "index", "vector", "graph"])), (F.col("event_id") % 5 + 1).cast("int"))
    return _table(spark, sf_dir, "events").select(F.concat(F.lit("run"), F.col("user_id").cast("string")).alias("run_id"), stage.alias("stage"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id"))


def refresh_audit(spark, sf_dir):
    receipts = _receipts(spark, sf_dir)
    return audits.refresh(receipts, receipts.agg(F.max("at").alias("now")), 168.0)


def _audited(spark, sf_dir):
    """Runs made of the events: receipts, pages, needs and a profile."""
    e = _table(spark, sf_dir, "events").withColumn("n", F.col("user_id") % 50)
    stage = F.element_at(F.array(*map(F.lit, readiness_ops.STAGES)), (F.when(F.col("n") == 49, F.col("event_id") % 4 + 1).otherwise(F.col("event_id") % 5) + 1).cast("int"))
    run = F.when(F.col("n") % 2 == 0, F.lit("run")).otherwise(F.concat(F.lit("run"), (F.col("event_id") % 2).cast("string")))
    chain = F.concat(F.lit("c"), F.col("n").cast("string")).alias("chain")
    flags = [(F.col("event_id") % k == 0).alias(c) for c, k in (("network_touched", 11), ("internal_search", 17), ("attachments", 19))]
    receipts = e.select(chain, stage.alias("stage"), F.col("event_id").alias("receipt_id"), run.alias("run_id"), F.when(F.col("n") % 10 == 3, "p2").otherwise("p1").alias("profile_id"), F.col("ts").cast("timestamp").alias("at"), (F.col("event_id") % 7 == 0).cast("int").alias("errors"), (F.col("event_id") % 13 != 0).alias("public_only"), *flags, (F.col("event_id") % 30).alias("items"))
    pages = e.select(chain, F.concat(F.lit("s"), (F.when(F.col("n") == 7, 99).otherwise(F.col("event_id") % 8)).cast("string")).alias("seed_id"), (F.floor(F.col("event_id") / 8) % 5 * 20).cast("string").alias("page_start"))
    wanted = spark.createDataFrame([("n1", ["f0"], ["a"], True, True, True), ("n2", ["f9"], ["a"], True, False, False), ("n3", ["f0", "f1"], [], False, True, True), ("n4", ["f1"], ["a", "z"], None, None, False), ("n5", ["f3"], ["b"], None, True, None)], "need_id string, seed_focus_any array<string>, eval_cases array<string>, eval_required boolean, for_ready boolean, for_deep boolean")
    cases = spark.createDataFrame([("a",), ("b",)], "case_id string")
    profile = {"profile_id": "p1", "information_need_matrix": "needs.json", **{k: f"{k}.json" for k in readiness_ops.SUITES}}
    suites = spark.createDataFrame([(f"{k}.json",) for k in readiness_ops.SUITES], "path string")
    needs = readiness_ops.need_states(wanted, _seeds(spark), pages, cases, receipts)
    checks = readiness_ops.coverage_checks(receipts, pages, policy.crawl_plan(_seeds(spark), 8), _seeds(spark), suites, readiness_ops.need_summary(needs), profile)
    return receipts, needs, checks


def need_states(spark, sf_dir):
    return _audited(spark, sf_dir)[1]


def coverage_checks(spark, sf_dir):
    return _audited(spark, sf_dir)[2]


def refresh_states(spark, sf_dir):
    receipts, _, checks = _audited(spark, sf_dir)
    return readiness_ops.refresh_states(readiness_ops.refresh_checks(receipts, receipts.agg(F.max("at").alias("now")), readiness_ops.coverage_states(checks)))


def readiness(spark, sf_dir):
    _, needs, checks = _audited(spark, sf_dir)
    found = readiness_ops.criteria(checks, readiness_ops.coverage_states(checks), readiness_ops.need_summary(needs), spark.createDataFrame([("reviewed",)], "status string"))
    return readiness_ops.readiness(found)


def latest_receipts(spark, sf_dir):
    return audits.latest_receipts(_receipts(spark, sf_dir)).select("stage", "run_id", "event_id")


def dedupe_latest(spark, sf_dir):
    return corpus.latest(_table(spark, sf_dir, "conversations"), ["conv_id", "role"], "turn", "text").select("conv_id", "role", "turn", "text")


def _sources(spark):
    rows = [(f"id{i}", f"https://forum.example.org/index.php?showtopic={i}&st={'x' if i % 5 == 0 else i * 20 - 20}", "topic" if i % 3 else "profile", "public" if i % 4 else "login", "none" if i % 6 else "images", ["Firmware", f"t{i % 3}"], i % 7 != 0) for i in range(30)]
    return spark.createDataFrame(rows, "source_id string, source_ref string, kind string, access string, include_media string, tags array<string>, enabled boolean")


def source_select(spark, sf_dir):
    return policy.select_sources(_sources(spark), kinds=["topic"], tags=["T1", "t2"]).select("source_id", "source_ref", policy.source_id(F.col("kind"), F.col("source_ref")).alias("stable_id"))


def preflight_errors(spark, sf_dir):
    return policy.preflight_errors(_sources(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        token_counts, technical_aliases, term_stats, corpus_stats, exact_terms, query_terms, specific_terms, keyword_search, hashed_vectors, blake_vectors, vector_search, hybrid_search,
        chunks, chunk_search, entity_mentions, relation_edges, graph_nodes, graph_edges, claim_rows, claim_kinds, claim_edges, claim_cross_edges, claim_stats, suite_checks, claim_nodes, merged_nodes, graph_search, graph_hybrid_search, grounding, evidence_chain, answer_labels, conflict_report, conflict_claims, answer_reports, answer_briefs,
        url_policy, page_titles, page_links, page_texts, page_posts, decoded_pages, discovery_candidates, seed_review, review_state, review_order, link_counts, coverage_summary, refresh_checks, source_upsert, source_errors, crawl_plan, coverage, missing_pages, need_coverage, route_ratio, refresh_audit, need_states, coverage_checks, refresh_states, readiness, latest_receipts, dedupe_latest, source_select, preflight_errors,
    )
}


def _sql() -> dict[str, str]:
    from tracewell.plans import oracles

    return oracles.build(ASKED, R)


SQL: dict[str, str] = _sql()
