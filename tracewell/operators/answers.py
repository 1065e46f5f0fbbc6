"""Answers from ranked evidence: what is grounded, in which order it is cited, and whether it is in conflict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Words that say nothing about a topic, words that ask for warnings, and edges that are one.
DEVICE_WORDS = ["10", "13t", "2306epn60g", "2306epn60r", "aristotle", "note", "pro", "redmi", "sweet", "xiaomi", "xig04"]
WEAK_WORDS = ["about", "help", "info", "question", "what", "where", "абсолютно", "вообще", "вопрос", "инфа", "информация", "какая", "какой", "какую", "кто", "несуществующий", "полностью", "почему", "совершенно", "такой", "такая", "что"]
WARNING_WORDS = ["danger", "dangerous", "risk", "warn", "warning", "опасно", "осторожно", "предупреждение", "предупреждения", "риск", "риски"]
WARNING_KINDS = ["warns_about", "source_warns_about_claim", "warning_targets_object", "warning_targets_action"]
CONFLICT, SUPERSEDED, CONTEXT = ["claim_contradicts_claim", "claim_deprecated_for_context"], ["claim_supersedes_claim"], ["claim_contextualizes_claim"]


def _content(c: Column) -> Column:
    """Distinct terms that say what a query is about."""
    low = F.transform(c, lambda x: F.lower(F.trim(x)))
    return F.array_distinct(F.filter(low, lambda x: (F.length(x) >= 3) & ~x.isin(DEVICE_WORDS) & ~x.isin(WEAK_WORDS)))


def requests(analysed: DataFrame, specific: DataFrame) -> DataFrame:
    """(query_id, content, structured, warning_requested): what evidence has to match."""
    own = specific.groupBy("query_id").agg(F.collect_set("term").alias("s"))
    said = F.concat("terms", "exact_terms", "technical_terms", F.coalesce("s", F.array().cast("array<string>")))
    structured = F.filter(_content(F.col("exact_terms")), lambda x: x.rlike(r"(?U)\d") & x.rlike(r"(?U)\p{L}"))
    return analysed.join(own, "query_id", "left").select("query_id", _content(said).alias("content"), structured.alias("structured"), F.arrays_overlap(said, F.array(*map(F.lit, WARNING_WORDS))).alias("warning_requested"))


def grounding(ranked: DataFrame, context: DataFrame, asked: DataFrame) -> DataFrame:
    """Reranked results with what of the request they match, and grounded: whether they may be cited."""
    kinds = context.groupBy("query_id", "key").agg(F.array_sort(F.collect_set("kind")).alias("relation_kinds"))
    none = F.array().cast("array<string>")
    out = ranked.join(kinds, ["query_id", "key"], "left").withColumn("relation_kinds", F.coalesce("relation_kinds", none)).join(F.broadcast(asked), "query_id")
    has = lambda names: F.arrays_overlap("relation_kinds", F.array(*map(F.lit, names)))
    matched = F.array_union(F.array_union("matched_terms", "matched_exact_terms"), F.array_union(F.flatten(F.transform("matched_phrases", lambda p: F.split(p, " "))), "matched_phrases"))
    out = out.withColumn("matched_count", F.size(F.array_intersect("content", matched))).withColumn("unmatched_structured", F.size(F.array_except("structured", matched)))
    intent = F.coalesce(F.col("matching_edge_count") > 0, F.lit(False))
    out = out.withColumn("relation_supported", F.when(F.col("asked_relations"), intent).otherwise(has(["fixes_issue", *WARNING_KINDS[:1], "warning_targets_object"])))
    out = out.withColumn("warning_supported", has(WARNING_KINDS))
    phrase = F.exists("matched_phrases", lambda p: F.arrays_overlap(F.split(p, " "), "content"))
    n, of = F.col("matched_count"), F.size("content")
    grounded = F.when(F.col("warning_requested") & ~F.col("warning_supported"), False).when(F.col("unmatched_structured") > 0, n >= 3).when(F.col("relation_supported"), True).when(of >= 5, n >= 3).when(n >= 2, True).otherwise((n >= 1) & phrase)
    return out.withColumn("grounded", grounded)


def _label(node: Column) -> Column:
    """The value of a node of an entity."""
    return F.element_at(F.split(node, ":", 3), 3)


def labels(rows: DataFrame, context: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with entities (query_id, key, source_url) and the labels of what their own post says: sorted arrays, and min_confidence of its relations.

    context are the relation edges of each row; found are the claims with their windows. Only relations within a post give labels, so these are few,
    however many other claims a claim is related to.
    """
    kind, to = F.col("kind"), F.col("to_node")
    pick = lambda when, node, name: F.array_sort(F.collect_set(F.when(when, _label(F.col(node))))).alias(name)
    local = context.groupBy("query_id", "key").agg(
        pick(kind == "fixes_issue", "from_node", "fix_labels"),
        pick(kind == "warns_about", "from_node", "warning_labels"),
        pick(kind == "warns_about", "to_node", "warned"),
        pick(kind.endswith("_targets_file") & to.startswith("entity:file:"), "to_node", "target_file_labels"),
        pick(kind.endswith("_uses_tool") & to.startswith("entity:tool:"), "to_node", "tool_labels"),
        pick(kind.endswith("_mentions_firmware") & to.rlike("^entity:(build_id|firmware_family|firmware_version):"), "to_node", "firmware_context_labels"),
        F.min("confidence").alias("min_confidence"),
    )
    every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    own = found.join(F.broadcast(rows.select("source_url").distinct()), "source_url", "left_semi").groupBy("source_url").agg(
        F.array_sort(F.collect_set("claim_id")).alias("claim_ids"), every("applicability_context").alias("claim_context_labels"), every("condition_labels").alias("claim_condition_labels"), F.array_sort(F.collect_set("profile_window")).alias("windows"), every(F.when(F.col("claim_kind") == "warning", F.col("target_labels"))).alias("targets"),
    )
    none = F.array().cast("array<string>")
    out = rows.join(local, ["query_id", "key"], "left").join(own, "source_url", "left")
    out = out.withColumns({c: F.coalesce(c, none) for c in (*local.columns[2:8], *own.columns[1:])})
    of = lambda k: F.array_sort(F.array_distinct(F.transform(F.filter("entities", lambda x: x["kind"] == k), lambda x: x["value"])))
    out = out.withColumns({"issue_labels": of("issue"), "root_action_labels": of("root_action"), "recovery_action_labels": of("recovery_action"), "warned_target_labels": F.array_sort(F.array_union("warned", "targets"))})
    some = lambda k: F.size(f"{k}_labels") > 0
    answer_kind = F.when(some("issue") & some("fix") & some("warning"), "issue_fix_warning").when(some("issue") & some("fix"), "issue_fix").when(some("warning"), "warning").when(some("root_action") & some("recovery_action"), "root_recovery").when(some("root_action"), "root").when(some("recovery_action"), "recovery").otherwise("snippet")
    return out.withColumn("answer_kind", answer_kind).drop("warned", "targets")


def evidence_chain(entries: DataFrame, context: DataFrame, found: DataFrame) -> DataFrame:
    """Grounded results, one for each post, with step, role, labels and answer_kind; the first is the primary one."""
    cited = entries.where("grounded").withColumn("_n", F.row_number().over(W.partitionBy("query_id", "post_id").orderBy("graph_rank"))).where("_n = 1").drop("_n")
    out = labels(cited, context, found).withColumn("step", F.row_number().over(W.partitionBy("query_id").orderBy("graph_rank")))
    has = lambda names: F.arrays_overlap("relation_kinds", F.array(*map(F.lit, names)))
    role = F.when(F.col("step") == 1, "primary").when(has(CONFLICT), "conflicting").when(has(SUPERSEDED), "superseding").when(has(CONTEXT), "contextual").when(F.size("warning_labels") > 0, "caution").when(F.size("relation_kinds") > 0, "supporting").otherwise("related_context")
    return out.withColumn("role", role)


def answer_texts(chain: DataFrame) -> DataFrame:
    """The chain with answer_text: a clause for each sort of label, or the snippet where there is none."""
    joined = lambda c: F.array_join(c, "; ")
    clause = lambda name, c: F.when(F.size(c) > 0, F.concat(F.lit(name + ": "), joined(c), F.lit(".")))
    about = F.when(F.size("warned_target_labels") > 0, F.concat(F.lit(" (about: "), joined("warned_target_labels"), F.lit(")"))).otherwise("")
    warning = F.when(F.size("warning_labels") > 0, F.concat(F.lit("Warnings: "), joined("warning_labels"), about, F.lit(".")))
    said = F.concat_ws(" ", clause("Issue", "issue_labels"), clause("Suggested fixes", "fix_labels"), warning, clause("Root actions", "root_action_labels"), clause("Recovery actions", "recovery_action_labels"), clause("Target files", "target_file_labels"), clause("Tools", "tool_labels"), clause("Firmware context", "firmware_context_labels"))
    return chain.withColumn("answer_text", F.coalesce(F.nullif(said, F.lit("")), F.trim("snippet")))


def conflict_claims(chain: DataFrame, context: DataFrame) -> DataFrame:
    """(query_id, role, claim_id): the claims that the chain's relations put in conflict, supersede or set in context; rows, for there may be many."""
    kind = F.col("kind")
    role = F.when(kind.isin(CONFLICT), "conflicting").when(kind.isin(SUPERSEDED), "superseding").when(kind.isin(CONTEXT), "contextual")
    edges = context.join(F.broadcast(chain.select("query_id", "key")), ["query_id", "key"], "left_semi").withColumn("role", role).where("role IS NOT NULL")
    ends = edges.select("query_id", "role", F.explode(F.array("from_node", "to_node")).alias("claim_id"))
    return ends.where(F.col("claim_id").startswith("claim:")).distinct()


def reports(entries: DataFrame, chain: DataFrame, context: DataFrame, asked: DataFrame) -> DataFrame:
    """One row for each query with candidates: what the chain rests on, how fresh it is, whether it applies, and what it warns of.

    asked: (query_id, query, warning_requested).
    """
    base = conflict_report(entries, chain)
    every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    steps = chain.groupBy("query_id").agg(
        F.count("*").alias("chain_step_count"), F.countDistinct("topic_id").alias("topic_count"), F.countDistinct("post_id").alias("post_count"), F.countDistinct("source_url").alias("source_count"),
        F.array_sort(F.collect_set("answer_kind")).alias("answer_kinds"), every("relation_kinds").alias("relation_kinds"), F.max("captured_at").alias("latest_captured_at"), every("windows").alias("profile_windows"),
        every(F.concat("firmware_context_labels", "claim_context_labels")).alias("context_labels"), every("claim_condition_labels").alias("condition_labels"), every("warning_labels").alias("warning_labels"), every("warned_target_labels").alias("warning_target_labels"),
    )
    warned = context.join(F.broadcast(chain.select("query_id", "key")), ["query_id", "key"], "left_semi").where(F.col("kind").isin(WARNING_KINDS) & F.col("kind").rlike("^(source_|warning_)"))
    warned = warned.select("query_id", "kind", "from_node", "to_node").distinct().groupBy("query_id").agg(F.count("*").alias("warning_relation_count"))
    seen = entries.groupBy("query_id").agg(F.count("*").alias("candidate_count"), F.count_if("grounded").alias("grounded_count"))
    out = base.join(seen, "query_id").join(steps, "query_id", "left").join(warned, "query_id", "left").join(F.broadcast(asked.select("query_id", "query", "warning_requested")), "query_id")
    none = F.array().cast("array<string>")
    out = out.fillna(0, ["chain_step_count", "topic_count", "post_count", "source_count", "warning_relation_count"]).withColumns({c: F.coalesce(c, none) for c in ("answer_kinds", "relation_kinds", "profile_windows", "context_labels", "condition_labels", "warning_labels", "warning_target_labels")})
    status, empty = F.col("conflict_status"), F.col("chain_step_count") == 0
    state = F.when(empty, "not_enough_local_evidence").when(status == "conflict_detected", "conflicting_evidence").when(status == "possibly_superseded", "possibly_superseded").when(F.array_contains("profile_windows", "latest_window"), "fresh_answer").when(status == "contextualized", "old_with_newer_context").otherwise("old_but_still_supported")
    now = F.lower("query").rlike("now|current|сейчас|актуаль|можно ли") & (F.size("context_labels") == 0)
    supported = (F.size("warning_labels") > 0) | (F.col("warning_relation_count") > 0)
    confidence = F.when(empty, "none").when(status == "conflict_detected", "bounded_conflict_visible").when(F.array_contains("relation_kinds", SUPERSEDED[0]), "bounded_freshness_pressure_visible").when(F.col("chain_step_count") >= 2, "supported_by_multiple_local_sources").otherwise("single_grounded_source")
    return out.withColumns({
        "filtered_count": F.col("candidate_count") - F.col("grounded_count"), "deduplicated_count": F.col("grounded_count") - F.col("chain_step_count"), "freshness_state": state, "applicability_status": F.when(empty | now, "context_required").otherwise("context_available"),
        "warning_supported": supported, "risk_status": F.when(supported, "warning_present").otherwise("no_warning_claim_in_evidence"), "confidence": confidence,
    })


def briefs(report: DataFrame, chain: DataFrame, base_name: str = "", most: int = 260) -> DataFrame:
    """(query_id, status, brief): a short cited answer in Russian, put together from fixed sentences; queries without evidence say what is missing."""
    flat = F.trim(F.regexp_replace("answer_text", r"(?U)\s+", " "))
    cut = F.concat(F.regexp_replace(F.regexp_replace(F.substring(flat, 1, most), " [^ ]*$", ""), "[.,;: ]+$", ""), F.lit("..."))
    first = chain.where("step = 1").select("query_id", F.regexp_replace(F.when(F.length(flat) > most, cut).otherwise(flat), r"\.$", "").alias("summary"))
    refs = chain.where("step > 1").groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("step")), lambda n: F.concat(F.lit("["), n.cast("string"), F.lit("]"))), ", ").alias("refs"))
    out = report.join(first, "query_id", "left").join(refs, "query_id", "left")
    limits = F.concat_ws("; ", F.when(F.col("filtered_count") > 0, F.concat(F.lit("отфильтровано слабых кандидатов: "), F.col("filtered_count").cast("string"))), F.when(F.col("deduplicated_count") > 0, F.concat(F.lit("схлопнуто дублей постов: "), F.col("deduplicated_count").cast("string"))))
    text = F.concat_ws(
        " ",
        F.concat(F.lit(f"По локальной базе{' ' * bool(base_name)}{base_name}: "), "summary", F.lit(" [1].")),
        F.when(F.col("refs").isNotNull(), F.concat(F.lit("Дополнительный контекст: см. "), "refs", F.lit("."))),
        F.when(F.col("latest_captured_at").isNotNull(), F.concat(F.lit("Свежесть: последнее локальное сохранение источников "), "latest_captured_at", F.lit("."))),
        F.when(limits != "", F.concat(F.lit("Ограничения: "), limits, F.lit("."))),
        F.when(F.col("conflict_status").isin("conflict_detected", "possibly_superseded", "contextualized"), F.concat(F.lit("Семантика claims: "), "conflict_status", F.lit("."))),
        F.when(F.col("warning_supported"), F.lit("Предупреждения/риски присутствуют в evidence.")),
    )
    return out.select("query_id", F.col("answer_status").alias("status"), F.when(F.col("answer_status") == "answered", text).otherwise(F.col("gap_reason")).alias("brief"))


def conflict_report(entries: DataFrame, chain: DataFrame) -> DataFrame:
    """(query_id, answer_status, conflict_status, cited, gap_reason) of each query with candidates."""
    asked = entries.groupBy("query_id").agg(F.count_if("grounded").alias("grounded"), F.min_by("unmatched_structured", "graph_rank").alias("open"))
    kinds = chain.groupBy("query_id").agg(F.flatten(F.collect_list("relation_kinds")).alias("kinds"), F.count("*").alias("cited"))
    has = lambda names: F.arrays_overlap("kinds", F.array(*map(F.lit, names)))
    status = F.when(F.col("grounded") == 0, "insufficient_evidence").when(has(CONFLICT), "conflict_detected").when(has(SUPERSEDED), "possibly_superseded").when(has(CONTEXT), "contextualized").otherwise("clear")
    gap = F.when(F.col("grounded") == 0, F.when(F.col("open") > 0, "unmatched_structured_query_terms").otherwise("candidate_evidence_below_grounding_threshold"))
    return asked.join(kinds, "query_id", "left").select("query_id", F.when(F.col("grounded") > 0, "answered").otherwise("insufficient_evidence").alias("answer_status"), status.alias("conflict_status"), F.coalesce("cited", F.lit(0)).alias("cited"), gap.alias("gap_reason"))
