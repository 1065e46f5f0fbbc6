"""Audits of a crawl: links that aren't seeds yet, their review, coverage of the plan, and age of what was derived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewell.operators.policy import Policy, allowed, canonical, page_start, topic_id


def candidates(links: DataFrame, seeds: DataFrame, terms: list[str], policy: Policy = Policy()) -> DataFrame:
    """(url, topic_id, page_start, candidate_kind, source_count, anchor_texts, review_priority) of allowed links outside the seed plan.

    links: (source_url, source_label, ord, url, anchor_text); seeds: (seed_id, url). Anchor texts are the first 8 distinct ones by ord.
    """
    planned = seeds.select(canonical(F.col("url")).alias("u"))
    keyed = planned.select(topic_id(F.col("u")).alias("topic_id"), page_start(F.col("u")).alias("page_start")).distinct()
    found = links.where(allowed(F.col("url"), policy)).withColumn("url", canonical(F.col("url")))
    found = found.withColumns({"topic_id": topic_id(F.col("url")), "page_start": page_start(F.col("url"))})
    found = found.join(F.broadcast(keyed), ["topic_id", "page_start"], "left_anti")
    firsts = found.where("trim(anchor_text) <> ''").groupBy("url", "anchor_text").agg(F.min("ord").alias("o")).withColumn("n", F.row_number().over(W.partitionBy("url").orderBy("o", "anchor_text"))).where("n <= 8")
    anchors = firsts.groupBy("url").agg(F.array_sort(F.collect_list(F.struct("n", "anchor_text"))).alias("a"))
    out = found.groupBy("url", "topic_id", "page_start").agg(F.count("*").alias("source_count"), F.max(F.concat_ws(" ", "source_label", "source_url").rlike("(?iu)" + "|".join(terms)) if terms else F.lit(False)).alias("source_hit"))
    out = out.join(anchors, "url", "left").withColumn("anchor_texts", F.coalesce(F.transform("a", lambda x: x["anchor_text"]), F.array().cast("array<string>")))
    out = out.join(F.broadcast(keyed.select("topic_id").distinct().withColumn("seeded", F.lit(True))), "topic_id", "left")
    kind = F.when(F.col("seeded"), "seed_topic_new_window").otherwise("unseeded_topic")
    said = F.lower(F.concat_ws(" ", "url", F.array_join("anchor_texts", " "), "topic_id"))
    hit = F.exists(F.array(*[F.lit(t.lower()) for t in terms]), lambda t: F.contains(said, t)) if terms else F.lit(False)
    priority = F.when(hit | F.coalesce("seeded", F.lit(False)) | (F.col("source_count") >= 8), "high").when(F.col("source_hit") | (F.col("source_count") >= 2), "medium").otherwise("low")
    return out.select("url", "topic_id", "page_start", kind.alias("candidate_kind"), "source_count", "anchor_texts", priority.alias("review_priority"))


def review(found: DataFrame, decisions: DataFrame, rules: DataFrame) -> DataFrame:
    """Candidates with a decision: the one for the address, else of the first rule that fits, else 'unreviewed'.

    decisions: (url, decision); rules: (rule_ord, candidate_kind, topic_id, min_source_count, decision), nulls fit everything. Both are short lists.
    """
    r = F.broadcast(rules.select("rule_ord", F.col("candidate_kind").alias("k"), F.col("topic_id").alias("t"), F.col("min_source_count").alias("m"), F.col("decision").alias("by_rule")))
    fits = (F.col("k").isNull() | (F.col("k") == F.col("candidate_kind"))) & (F.col("t").isNull() | (F.col("t") == F.col("topic_id"))) & (F.col("m").isNull() | (F.col("source_count") >= F.col("m")))
    first = found.select("url", "candidate_kind", "topic_id", "source_count").join(r, fits).groupBy("url").agg(F.min_by("by_rule", "rule_ord").alias("by_rule"))
    out = found.join(F.broadcast(decisions.select("url", F.col("decision").alias("exact"))), "url", "left").join(first, "url", "left")
    return out.withColumn("decision", F.coalesce("exact", "by_rule", F.lit("unreviewed"))).drop("exact", "by_rule")


def stale_decisions(decisions: DataFrame, found: DataFrame, seeds: DataFrame) -> DataFrame:
    return decisions.join(found.select("url"), "url", "left_anti").join(seeds.select(canonical(F.col("url")).alias("url")), "url", "left_anti")


def review_summary(reviewed: DataFrame, stale: DataFrame, seeds: DataFrame, has_manifest: bool = True, has_run: bool = True) -> DataFrame:
    """One row: candidates by decision, accepted ones that are seeds and that aren't, stale decisions, and the state of the review."""
    seeded = seeds.select(canonical(F.col("url")).alias("url")).distinct().withColumn("is_seed", F.lit(True))
    rows = reviewed.join(F.broadcast(seeded), "url", "left")
    accepted = F.col("decision") == "accept"
    one = rows.agg(
        F.count("*").alias("candidate_count"), F.count_if(F.col("decision") == "unreviewed").alias("unreviewed_count"), F.count_if(accepted & F.col("is_seed").isNotNull()).alias("accepted_seeded_count"), F.count_if(accepted & F.col("is_seed").isNull()).alias("accepted_missing_from_seed_count"), F.count_if(F.col("decision") == "reject").alias("rejected_count"),
    ).crossJoin(stale.agg(F.count("*").alias("stale_decision_count")))
    state = F.when(~F.lit(has_run), "missing_run").when(~F.lit(has_manifest), "missing_review").when(F.col("unreviewed_count") > 0, "needs_review").when(F.col("accepted_missing_from_seed_count") > 0, "reviewed_pending_seed_update").otherwise("reviewed")
    return one.withColumn("status", state)


def link_counts(links: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """(verdict, links, addresses): how many links the policy lets through and how many it denies."""
    verdict = F.when(allowed(F.col("url"), policy), "allowed").otherwise("denied")
    return links.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("links"), F.countDistinct("url").alias("addresses"))


def review_order(found: DataFrame, limit: int) -> DataFrame:
    """The first candidates to review, with their place: by priority, unseeded topics first, then by how often they are linked."""
    rank = F.when(F.col("review_priority") == "high", 0).when(F.col("review_priority") == "medium", 1).otherwise(2)
    first = found.orderBy(rank, (F.col("candidate_kind") == "seed_topic_new_window").cast("int"), F.col("source_count").desc(), "topic_id", "page_start", "url").limit(limit)
    return first.withColumn("place", F.row_number().over(W.orderBy(rank, (F.col("candidate_kind") == "seed_topic_new_window").cast("int"), F.col("source_count").desc(), "topic_id", "page_start", "url")))


def coverage_summary(seeds: DataFrame, plan: DataFrame, fetched: DataFrame) -> DataFrame:
    """One row: pages, seeds and focus areas that are expected, there and missing, and the status no_run, partial or coverage_ready."""
    got = fetched.select("seed_id", "page_start").distinct()
    there = got.select("seed_id").distinct().withColumn("there", F.lit(1))
    pages = plan.select("seed_id", "page_start").distinct().join(got.withColumn("there", F.lit(1)), ["seed_id", "page_start"], "left").agg(F.count("*").alias("expected_pages"), F.count("there").alias("fetched_pages"))
    own = plan.select("seed_id").distinct().join(seeds.select("seed_id", "focus"), "seed_id").join(there, "seed_id", "left")
    counts = own.agg(F.count("*").alias("expected_seeds"), F.count("there").alias("fetched_seeds"), F.countDistinct("focus").alias("expected_focus"), F.countDistinct(F.when(F.col("there") == 1, F.col("focus"))).alias("captured_focus"))
    out = pages.crossJoin(counts).crossJoin(got.agg(F.count("*").alias("_any")))
    status = F.when(F.col("_any") == 0, "no_run").when((F.col("expected_pages") > 0) & (F.col("expected_pages") == F.col("fetched_pages")) & (F.col("expected_focus") == F.col("captured_focus")), "coverage_ready").otherwise("partial")
    ratio = F.when(F.col("expected_pages") > 0, F.round(F.col("fetched_pages") / F.col("expected_pages"), 4)).otherwise(0.0)
    return out.withColumn("page_ratio", ratio).withColumn("status", status).drop("_any")


def refresh_checks(receipts: DataFrame, now: DataFrame, max_age_hours: float = 168.0) -> DataFrame:
    """(run_id, check, ok): what a run needs to count as fresh, from receipts(run_id, stage, at, errors, network_touched)."""
    stages = ["crawl", "normalize", "index", "vector", "graph"]
    at = {s: F.max(F.when(F.col("stage") == s, F.col("at"))) for s in stages}
    derived = F.col("stage").isin(stages[1:])
    wide = receipts.groupBy("run_id").agg(*[c.alias(s) for s, c in at.items()], F.max(F.when(F.col("stage") == "crawl", F.col("errors"))).alias("errors"), F.bool_or(F.when(derived, F.col("network_touched"))).alias("touched")).crossJoin(F.broadcast(now))
    age = (F.col("now").cast("timestamp").cast("double") - F.col("crawl").cast("double")) / 3600
    checks = {
        "receipt_chain_present": F.forall(F.array(*stages), lambda x: x.isNotNull()),
        "crawl_age_within_limit": F.round(F.greatest(F.lit(0.0), age), 2) <= max_age_hours,
        "crawl_errors_zero": F.col("errors") == 0,
        "derived_stages_network_free": F.forall(F.array(*stages[1:]), lambda x: x.isNotNull()) & ~F.col("touched"),
        "derived_timestamps_present": F.forall(F.array(*stages[1:]), lambda x: x.isNotNull()),
        "derived_not_older_than_crawl": (F.col("normalize") >= F.col("crawl")) & (F.col("index") >= F.col("normalize")) & (F.col("vector") >= F.col("normalize")) & (F.col("graph") >= F.col("normalize")),
    }
    one = F.array(*[F.struct(F.lit(n).alias("check"), F.coalesce(c, F.lit(False)).alias("ok")) for n, c in checks.items()])
    return wide.select("run_id", F.explode(one).alias("x")).select("run_id", "x.check", "x.ok")


def missing_pages(plan: DataFrame, fetched: DataFrame) -> DataFrame:
    """Planned (seed_id, page_start) that weren't fetched."""
    return plan.join(fetched.select("seed_id", "page_start").distinct(), ["seed_id", "page_start"], "left_anti")


def coverage(plan: DataFrame, fetched: DataFrame) -> DataFrame:
    """(seed_id, planned, fetched_pages, ratio): how much of each seed's plan was fetched."""
    got = fetched.select("seed_id", "page_start").distinct().withColumn("got", F.lit(1))
    out = plan.select("seed_id", "page_start").distinct().join(got, ["seed_id", "page_start"], "left")
    return out.groupBy("seed_id").agg(F.count("*").alias("planned"), F.count("got").alias("fetched_pages")).withColumn("ratio", F.round(F.col("fetched_pages") / F.col("planned"), 4))


def needs(wanted: DataFrame, seeds: DataFrame, fetched: DataFrame) -> DataFrame:
    """(need_id, status) of wanted(need_id, seed_focus_any, eval_cases): missing_seed_focus, unmaterialized, missing_eval_route or covered."""
    have = seeds.select("focus", "seed_id").join(fetched.select("seed_id").distinct().withColumn("got", F.lit(True)), "seed_id", "left")
    focus = wanted.select("need_id", F.explode("seed_focus_any").alias("focus")).join(have, "focus")
    found = focus.groupBy("need_id").agg(F.lit(True).alias("seeded"), F.max(F.coalesce("got", F.lit(False))).alias("got"))
    out = wanted.join(found, "need_id", "left")
    status = F.when(F.col("seeded").isNull(), "missing_seed_focus").when(~F.coalesce("got", F.lit(False)), "unmaterialized").when(F.size("eval_cases") <= 0, "missing_eval_route").otherwise("covered")
    return out.select("need_id", status.alias("status"))


def route_ratio(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """(complete, total, ratio): the share of needs that name evaluation cases, all of which exist; known: (case_id)."""
    declared = wanted.select("need_id", F.explode_outer("eval_cases").alias("case_id"))
    open_ = declared.join(F.broadcast(known.select("case_id").distinct().withColumn("there", F.lit(1))), "case_id", "left").groupBy("need_id").agg(F.count("case_id").alias("declared"), F.count_if(F.col("case_id").isNotNull() & F.col("there").isNull()).alias("unresolved"))
    return open_.agg(F.count_if((F.col("declared") > 0) & (F.col("unresolved") == 0)).alias("complete"), F.count("*").alias("total")).withColumn("ratio", F.round(F.col("complete") / F.col("total"), 4))


def refresh(receipts: DataFrame, now: DataFrame, max_age_hours: float = 168.0) -> DataFrame:
    """(run_id, age_hours, derived_in_order, status) of receipts(run_id, stage, at): missing_run, needs_refresh or fresh. now: one row with the clock."""
    stages = ["crawl", "normalize", "index", "vector", "graph"]
    wide = receipts.groupBy("run_id").pivot("stage", stages).agg(F.max("at"))
    at = {s: F.col(s).cast("timestamp") for s in stages}
    age = F.round(F.greatest(F.lit(0.0), (F.col("now").cast("timestamp").cast("double") - at["crawl"].cast("double")) / 3600), 2)
    order = (at["normalize"] >= at["crawl"]) & (at["index"] >= at["normalize"]) & (at["vector"] >= at["normalize"]) & (at["graph"] >= at["normalize"])
    out = wide.crossJoin(F.broadcast(now)).withColumn("age_hours", age).withColumn("derived_in_order", F.coalesce(order, F.lit(False)))
    status = F.when(F.col("crawl").isNull(), "missing_run").when((F.col("age_hours") <= max_age_hours) & F.col("derived_in_order"), "fresh").otherwise("needs_refresh")
    return out.select("run_id", "age_hours", "derived_in_order", status.alias("status"))


def latest_receipts(receipts: DataFrame) -> DataFrame:
    """The newest receipt of each stage."""
    return receipts.groupBy("stage").agg(F.max_by(F.struct(*[c for c in receipts.columns if c != "stage"]), F.struct("at", "run_id")).alias("r")).select("stage", "r.*")
