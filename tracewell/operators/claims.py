"""Claims of posts, their places in time, and edges between claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewell.functions import rules as R
from tracewell.functions.text import slug
from tracewell.operators.stages import once, stored


def _has(low: Column, terms: list[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | low.contains(t)
    return out


def _set(c: Column) -> Column:
    return F.array_sort(F.array_distinct(c))


def _labels(low: Column, pairs: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*[F.when(c, name) for c, name in pairs]))


def _action(low: Column) -> Column:
    any_of = lambda *t: _has(low, list(t))
    return F.when(any_of("restore", "восстанов", "верн"), "restore").when(any_of("patch", "патч"), "patch").when(any_of("flash", "прош", "install"), "flash").when(any_of("no longer", "не работает"), "status_update").when(_has(low, R.WARNING_TERMS), "warn").otherwise(slug(low))


def post_order(post_id: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(post_id, r"\D+", ""), F.lit("")).cast("bigint"), F.lit(0).cast("bigint"))


def claims(posts: DataFrame, profile: str = "starter") -> DataFrame:
    """A row for each claim of posts(post_id, topic_id, source_url, posted_at, captured_at, text, entities)."""
    posts = once(posts, "_clean", F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U) \s+|[^\S ]\s*", " ")))  # single blanks stay as they are
    posts = once(posts, "_clean_low", F.lower("_clean"))
    posts = once(posts, "_low", F.lower(F.coalesce("text", F.lit(""))))
    e, low = F.col("entities"), F.col("_low")
    of = lambda *kinds: F.transform(F.filter(e, lambda x: x["kind"].isin(*kinds)), lambda x: x["value"])
    within = lambda label, *kinds: F.transform(F.filter(e, lambda x: x["kind"].isin(*kinds) & F.lower(label).contains(F.lower(x["value"]))), lambda x: x["value"])
    either = lambda a, b: _set(F.when(F.size(a) > 0, a).otherwise(b))
    tools = lambda *names: _set(F.filter(of("tool"), lambda t: t.isin(*names)) if names else of("tool"))
    after = low.contains("после обнов") | low.contains("after update")
    context = _set(F.concat(of("device", "device_model", "codename", "firmware_family", "firmware_version", "build_id"), _labels(low, [(_has(low, ["global", "глобал"]), "region:global"), (_has(low, ["eea", "europe", "европ"]), "region:eea"), (_has(low, ["china", "китай"]), "region:china"), (after, "after_update")])))
    condition = _set(_labels(low, [(_has(low, ["bootloader", "загрузчик"]) & _has(low, ["unlock", "разблок"]), "bootloader_unlocked"), (low.contains("fastbootd"), "fastbootd_available"), (_has(low, ["matching", "родной", "стоковой прошивки"]), "matching_firmware_required")]))
    risk = _set(F.concat(of("issue"), _labels(low, [(low.contains("fastbootd") & _has(low, ["кирпич", "brick"]), "brick_fastbootd"), (_has(low, ["не ставить", "do not install", "не прошивать"]), "unsafe_flash")])))
    review = _has(low, R.REVIEW_TERMS)
    clean = F.col("_clean")
    first_term = F.array_min(F.filter(F.array(*[F.instr(F.col("_clean_low"), t) for t in R.WARNING_TERMS]), lambda p: p > 0))
    excerpt = F.trim(clean.substr(F.greatest(F.lit(1), first_term - 50), F.lit(220)))
    warned = of("warning")
    spoken = F.when((F.size(warned) == 0) & _has(low, R.WARNING_TERMS), F.array(excerpt)).otherwise(warned)
    negative = _has(low, R.NEGATIVE_TERMS)
    update = _has(low, R.UPDATE_TERMS + R.NEGATIVE_TERMS)
    status = F.when(negative, "no longer works for current context").when(after, "after update context changes applicability").otherwise("current update context")

    def claim(kind: str, method: str, label: Column, targets: Column, own_tools: Column, risks: Column, warnings: Column, confidence: Column, rule: str, manual: Column, updates: bool = False) -> Column:
        names = {"claim_kind": F.lit(kind), "method_kind": F.lit(method), "action_label": label, "target_labels": targets, "tool_labels": own_tools, "risk_labels": risks, "warning_labels": warnings, "confidence": confidence, "extraction_rule": F.lit(rule), "manual_review_required": manual, "source_updates_prior_claims": F.lit(updates)}
        return F.struct(*[c.alias(n) for n, c in names.items()])

    found = [
        F.transform(of("root_action"), lambda a: claim("method", "root", a, either(within(a, "file"), of("file")), tools("KSU", "Magisk"), risk, _set(warned), F.lit(0.72), "root_action_entity_v1", review)),
        F.transform(of("recovery_action"), lambda a: claim("method", "recovery", a, either(within(a, "file"), of("file")), tools("OrangeFox", "TWRP", "fastboot"), risk, _set(warned), F.lit(0.72), "recovery_action_entity_v1", review)),
        F.transform(of("fix"), lambda a: claim("method", "issue_recovery", a, either(within(a, "file", "issue"), of("file", "issue")), tools(), risk, _set(warned), F.lit(0.62), "fix_entity_v1", review)),
        F.transform(spoken, lambda a: claim("warning", "risk_warning", a, either(within(a, "file", "codename", "device", "firmware_family", "firmware_version", "build_id", "tool"), of("file", "codename", "firmware_family", "firmware_version")), tools(), F.when(F.size(risk) > 0, risk).otherwise(F.array(F.lit("unsafe_without_matching_context"))), F.array(a), F.when(F.size(warned) > 0, 0.7).otherwise(0.55), "warning_entity_or_language_v1", review | (F.size(warned) == 0))),
        F.when(update, F.array(claim("status", "freshness_update", status, _set(of("file", "firmware_family", "firmware_version", "build_id")), tools(), risk, F.array().cast("array<string>"), F.lit(0.58), "freshness_language_v1", F.lit(True), True))),
    ]
    kept = ["post_id", "topic_id", "source_url", "posted_at", "captured_at"]
    none = F.filter(found[0], lambda x: F.lit(False))
    posts = once(posts, "_claims", F.concat(*[F.coalesce(f, none) for f in found])).where(F.size("_claims") > 0)
    rows = posts.select(*kept, clean.alias("clean"), F.col("_clean_low").alias("clean_low"), context.alias("applicability_context"), condition.alias("condition_labels"), F.posexplode("_claims").alias("seq", "c"))
    rows = rows.select(*kept, "clean", "clean_low", "applicability_context", "condition_labels", "seq", "c.*")
    three = lambda c: F.array_join(F.slice(c, 1, 3), ", ")
    part = lambda name, c: F.when(F.size(c) > 0, F.concat(F.lit(name), three(F.col(c))))
    rows = rows.withColumn("action", _action(F.lower("action_label"))).withColumn("label", F.concat_ws(" | ", F.nullif("action_label", F.lit("")), part("targets ", "target_labels"), part("uses ", "tool_labels"), part("context ", "applicability_context")))
    targets = F.array_join("target_labels", "_")
    rows = rows.withColumn("method_id", F.concat(F.lit(f"method:{profile}:"), slug(F.col("method_kind")), F.lit(":"), slug(F.col("action")), F.lit(":"), slug(F.when(targets != "", targets).otherwise(F.col("action_label")))))
    head = F.concat(F.lit(f"claim:{profile}:"), "post_id", F.lit(":"), slug(F.col("claim_kind")), F.lit(":"))
    full = F.concat(head, slug(F.col("label")))
    rows = rows.withColumn("claim_id", F.when(F.length(full) > 140, F.concat(head, F.substring(F.sha2("label", 256), 1, 16))).otherwise(full))
    keyed = lambda c: F.array_join(F.array_sort(F.transform(c, slug)), "|")
    rows = rows.withColumn("relation_key", F.concat(slug(F.col("action")), F.lit(":"), keyed("target_labels"), F.lit(":"), keyed("tool_labels")))
    at = F.greatest(F.call_function("locate", F.lower("action_label"), F.col("clean_low")) - 1, F.lit(0))
    rows = rows.withColumn("evidence_start", at).withColumn("evidence", F.col("clean").substr(F.col("evidence_start") + 1, F.lit(260)))
    when = F.coalesce(F.try_to_timestamp("posted_at", F.lit("dd.MM.yy, HH:mm")), F.try_to_timestamp("captured_at"))
    rows = rows.withColumn("time_key", F.when(when.isNotNull(), F.struct(F.lit(1).alias("known"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss").alias("at"), post_order(F.col("post_id")).alias("no"))).otherwise(F.struct(F.lit(0).alias("known"), F.col("claim_id").alias("at"), post_order(F.col("post_id")).alias("no"))))
    first = rows.withColumn("_n", F.row_number().over(W.partitionBy("post_id", "claim_id").orderBy("seq")))
    return first.where("_n = 1").drop("_n", "clean", "clean_low", "seq")


def freshness_windows(rows: DataFrame) -> DataFrame:
    """Adds profile_window (early, middle, late, latest_window by rank in time) and newer_related_count.

    The rank over all claims is a count of the days before plus the rank in the day, so no task sorts them all.
    """
    rows = rows.withColumn("_day", F.struct(F.col("time_key.known"), F.substring(F.col("time_key.at"), 1, 10)))
    days = rows.groupBy("_day").agg(F.count("*").alias("n"))
    before = days.alias("a").join(days.alias("b"), F.col("b._day") < F.col("a._day"), "left").groupBy("a._day").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    total = rows.agg(F.count("*").alias("_total"))
    rows = rows.join(F.broadcast(before), "_day").crossJoin(F.broadcast(total))
    i = F.col("before") + F.row_number().over(W.partitionBy("_day").orderBy("time_key", "claim_id")) - 1
    rows = rows.withColumn("_i", i)
    window = F.when(F.col("_i") == F.col("_total") - 1, "latest_window").when(F.col("_i") * 3 < F.col("_total"), "early").when(F.col("_i") * 3 < 2 * F.col("_total"), "middle").otherwise("late")
    by_key = rows.groupBy("relation_key", "time_key").agg(F.count("*").alias("_n"))
    later = W.partitionBy("relation_key").orderBy(F.col("time_key").desc()).rowsBetween(W.unboundedPreceding, -1)
    newer = by_key.select("relation_key", "time_key", F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("newer_related_count"))
    return rows.withColumn("profile_window", window).drop("_day", "before", "_total", "_i").join(newer, ["relation_key", "time_key"])


def claim_edges(rows: DataFrame) -> DataFrame:
    """(kind, from_node, to_node, claim_id, source_url, post_id, confidence): from posts, claims and methods to what they are about."""
    name = lambda p: lambda x: F.concat(F.lit(p + ":"), slug(x))
    post, action = F.concat(F.lit("post:"), "post_id"), name("action")(F.col("action"))
    warns = F.col("claim_kind") == "warning"

    def one(kind, a, b, c, when=None):
        kind = F.lit(kind) if isinstance(kind, str) else kind
        s = F.array(F.struct(kind.alias("kind"), a.alias("from_node"), b.alias("to_node"), c.cast("double").alias("confidence")))
        return s if when is None else F.when(when, s)

    def many(kind, a, labels, prefix, c, when=None):
        s = F.transform(labels, lambda x: F.struct(F.lit(kind).alias("kind"), a.alias("from_node"), name(prefix)(x).alias("to_node"), F.lit(c).alias("confidence")))
        return s if when is None else F.when(when, s)

    claim, method, sure = F.col("claim_id"), F.col("method_id"), F.col("confidence")
    parts = [
        one(F.when(warns, "source_warns_about_claim").otherwise("source_supports_claim"), post, claim, sure),
        one("source_updates_claim", post, claim, F.lit(0.55), F.col("claim_kind") == "status"),
        one("post_mentions_claim", post, claim, sure),
        one("claim_applies_to_context", claim, action, F.lit(0.55)),
        many("claim_applies_to_context", claim, F.col("applicability_context"), "context", 0.55),
        one("claim_refines_claim", claim, method, F.lit(0.45)),
        many("method_uses_tool", method, F.col("tool_labels"), "tool", 0.6),
        many("method_targets_object", method, F.col("target_labels"), "target", 0.65),
        many("method_requires_condition", method, F.col("condition_labels"), "condition", 0.5),
        many("warning_targets_object", claim, F.col("target_labels"), "target", 0.62, warns),
        one("warning_targets_action", claim, action, F.lit(0.55), warns),
    ]
    none = F.filter(parts[0], lambda x: F.lit(False))
    out = rows.select("claim_id", "source_url", "post_id", F.explode(F.concat(*[F.coalesce(p, none) for p in parts])).alias("x"))
    return out.select("x.kind", "x.from_node", "x.to_node", "claim_id", "source_url", "post_id", "x.confidence").groupBy("kind", "from_node", "to_node", "post_id").agg(F.min("claim_id").alias("claim_id"), F.min("source_url").alias("source_url"), F.max("confidence").alias("confidence")).select("kind", "from_node", "to_node", "claim_id", "source_url", "post_id", "confidence")


def _named(rows: DataFrame) -> DataFrame:
    """(node_id, kind, label, source_url, confidence): a row for each node that a claim names."""
    name = lambda prefix: lambda x: F.concat(F.lit(prefix + ":"), slug(x))
    node = lambda i, kind, label, c: F.struct(i.alias("node_id"), F.lit(kind).alias("kind"), label.alias("label"), F.lit(c).cast("double").alias("confidence"))
    many = lambda c, kind, prefix, confidence: F.transform(c, lambda x: node(name(prefix)(x), kind, x, confidence))
    warning = lambda x: F.concat(F.lit("warning:"), F.substring(slug(x), 1, 60), F.lit(":"), F.substring(F.sha2(x, 256), 1, 12))
    parts = [
        F.array(node(F.col("claim_id"), "claim", F.col("label"), 0.0), node(F.col("method_id"), "method", F.concat_ws(" ", "method_kind", "action"), 0.65), node(name("action")(F.col("action")), "action", F.col("action"), 0.65)),
        many("target_labels", "target", "target", 0.65),
        many("tool_labels", "tool", "tool", 0.65),
        many("condition_labels", "condition", "condition", 0.6),
        many("applicability_context", "applicability_context", "context", 0.6),
        many("risk_labels", "risk", "risk", 0.6),
        F.transform("warning_labels", lambda x: node(warning(x), "warning", x, 0.65)),
    ]
    found = rows.select("source_url", "confidence", F.explode(F.concat(*parts)).alias("x"))
    return found.select("x.node_id", "x.kind", "x.label", "source_url", F.when(F.col("x.kind") == "claim", F.col("confidence")).otherwise(F.col("x.confidence")).alias("confidence"))


def claim_nodes(rows: DataFrame) -> DataFrame:
    """(node_id, kind, label, source_refs, confidence): claims, and the methods, actions, targets, tools, conditions, contexts, risks and warnings that they name.

    Of several labels of one node the first in the alphabet counts.
    """
    return _named(rows).groupBy("node_id").agg(F.min("kind").alias("kind"), F.min("label").alias("label"), F.array_sort(F.collect_set("source_url")).alias("source_refs"), F.max("confidence").alias("confidence"))


def claim_node_counts(rows: DataFrame) -> DataFrame:
    """claim_nodes with refs, the number of references of a node, instead of their list, which holds most addresses for a common target."""
    return _named(rows).groupBy("node_id", "source_url").agg(F.min("kind").alias("kind"), F.min("label").alias("label"), F.max("confidence").alias("confidence")).groupBy("node_id").agg(F.min("kind").alias("kind"), F.min("label").alias("label"), F.count("source_url").alias("refs"), F.max("confidence").alias("confidence"))


def merged_nodes(graph: DataFrame, claimed: DataFrame) -> DataFrame:
    """Nodes of the graph and of claims; where both have one, the graph's fields count and the references of both are joined."""
    both = graph.withColumn("o", F.lit(0)).unionByName(claimed.withColumn("o", F.lit(1)))
    merged = both.groupBy("node_id").agg(F.min_by(F.struct("kind", "label", "confidence"), "o").alias("f"), F.array_sort(F.collect_list(F.struct("o", "source_refs"))).alias("r"))
    return merged.select("node_id", "f.kind", "f.label", F.array_distinct(F.flatten(F.transform("r", lambda x: x["source_refs"]))).alias("source_refs"), "f.confidence")


def _sides(rows: DataFrame) -> DataFrame:
    """What decides how claims are related."""
    says = F.lower(F.concat_ws(" ", F.array_join("warning_labels", " "), "label"))
    return rows.select("claim_id", "claim_kind", "post_id", "source_url", "target_labels", "relation_key", "time_key", (F.col("claim_kind") == "warning").alias("warns"), _has(says, R.WARNING_TERMS + R.NEGATIVE_TERMS).alias("strong"), (F.col("source_updates_prior_claims") | _has(F.lower("label"), R.UPDATE_TERMS + R.NEGATIVE_TERMS)).alias("updates"))


def cross_edge_counts(rows: DataFrame) -> DataFrame:
    """(claim_id, kind, confidence, manual_review_required, edges): how many relations between claims begin at each claim, without making them.

    Claims with the same targets, key and flags are one class, and classes are compared instead of claims: a claim's relations to a class are
    the class without the claims of its own post, or, where the later one counts, those of it that are older, which are sums over days and in a day.
    The work grows with the claims times the classes that each is related to.
    """
    base = _sides(rows).withColumn("cls", F.xxhash64("target_labels", "relation_key", "warns", "strong", "updates"))
    base = stored(base.withColumn("day", F.struct(F.col("time_key.known"), F.substring(F.col("time_key.at"), 1, 10).alias("d"))).drop("source_url", "claim_kind"))
    classes = base.groupBy("cls").agg(*[F.first(c).alias(c) for c in ("target_labels", "relation_key", "warns", "strong", "updates")], F.count("*").alias("n"))
    keyed = classes.select("cls", "warns", "strong", "updates", "n", F.explode(F.concat(F.transform("target_labels", lambda t: F.concat(F.lit("t:"), t)), F.array(F.concat(F.lit("k:"), "relation_key")))).alias("key"))
    a, b = (keyed.select("key", *[F.col(c).alias(f"{p}_{c}") for c in ("cls", "warns", "strong", "updates", "n")]) for p in "ab")
    pairs = a.join(b, "key").where("(a_warns AND NOT b_warns) OR a_updates").select("a_cls", "b_cls", (F.col("a_warns") & ~F.col("b_warns")).alias("against"), F.col("a_strong").alias("strong"), F.col("a_updates").alias("updates"), "a_n", "b_n").distinct()
    pairs = stored(pairs)
    own = base.groupBy("post_id", "cls").agg(F.count("*").alias("own"))

    def others(side: str, other: str, when: str) -> DataFrame:
        """Claims of one side with the number of claims in other posts on the other side."""
        near = base.select("claim_id", "post_id", F.col("cls").alias(f"{side}_cls")).join(pairs.where(when), f"{side}_cls")
        near = near.join(own.withColumnRenamed("cls", f"{other}_cls"), ["post_id", f"{other}_cls"], "left")
        return near.select("claim_id", "strong", (F.col(f"{other}_n") - F.coalesce("own", F.lit(0))).alias("edges")).where("edges > 0")

    later = base.select("claim_id", "time_key", "day", F.col("cls").alias("a_cls")).join(pairs.where("updates").select("a_cls", "b_cls", "against"), "a_cls").drop("a_cls")
    times = base.select(F.col("cls").alias("b_cls"), "day", "time_key", F.lit(1).alias("c")).unionByName(later.select("b_cls", "day", "time_key", F.lit(0).alias("c")))
    times = times.groupBy("b_cls", "day", "time_key").agg(F.sum("c").alias("c"))
    before = lambda *by: W.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(W.unboundedPreceding, -1)
    days = times.groupBy("b_cls", "day").agg(F.sum("c").alias("c")).select("b_cls", "day", F.coalesce(F.sum("c").over(before("b_cls", "day")), F.lit(0)).alias("earlier"))
    older = times.withColumn("today", F.coalesce(F.sum("c").over(before("b_cls", "day", "time_key")), F.lit(0))).join(days, ["b_cls", "day"]).select("b_cls", "time_key", (F.col("earlier") + F.col("today")).alias("edges"))
    later = later.drop("day").join(older, ["b_cls", "time_key"]).where("edges > 0")

    def edges(df: DataFrame, kind: str, confidence: float, manual: bool) -> DataFrame:
        return df.select("claim_id", F.lit(kind).alias("kind"), F.lit(confidence).alias("confidence"), F.lit(manual).alias("manual_review_required"), "edges")

    forward = others("a", "b", "against")
    return (
        edges(forward, "claim_contextualizes_claim", 0.55, False)
        .unionByName(edges(forward.where("strong"), "claim_contradicts_claim", 0.52, True))
        .unionByName(edges(others("b", "a", "against AND strong"), "claim_deprecated_for_context", 0.5, True))
        .unionByName(edges(later, "claim_supersedes_claim", 0.5, True))
        .unionByName(edges(later.where("NOT against"), "claim_contextualizes_claim", 0.5, True))
    )


def cross_edges(rows: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """(kind, from_node, to_node, confidence, manual_review_required, source_urls) between related claims of different posts.

    With a short list of addresses, of(source_url), only edges that name one of them.

    Related are claims with a common target or an equal relation key: two equi-joins instead of a comparison of all with all. Only warnings
    and updates are on the side that edges start from.
    """
    return _edges(_pairs(rows, of).dropDuplicates(["a_claim_id", "b_claim_id"]))


def _pairs(rows: DataFrame, of: DataFrame | None) -> DataFrame:
    """The related claims, a pair for each key that they have in common."""
    base = _sides(rows)
    a = base.where("warns OR updates").select(*[F.col(c).alias("a_" + c) for c in base.columns])
    b = base.select(*[F.col(c).alias("b_" + c) for c in base.columns])
    keyed = lambda d, p: d.select("*", F.explode(F.concat(F.transform(f"{p}_target_labels", lambda t: F.concat(F.lit("t:"), t)), F.array(F.concat(F.lit("k:"), f"{p}_relation_key")))).alias("key"))
    useful = "a_post_id <> b_post_id AND ((a_warns AND NOT b_warns) OR (a_updates AND a_time_key > b_time_key))"
    if of is None:
        pairs = keyed(a, "a").join(keyed(b, "b"), "key")
    else:
        near = lambda d, p: F.broadcast(keyed(d, p).join(F.broadcast(of.withColumnRenamed("source_url", f"{p}_source_url")), f"{p}_source_url", "left_semi"))
        pairs = keyed(b, "b").join(near(a, "a"), "key")
        pairs = pairs.unionByName(keyed(a, "a").join(near(b, "b"), "key"))
    return pairs.where(useful).drop("key", "a_target_labels", "b_target_labels")


def _edges(pairs: DataFrame) -> DataFrame:
    against = F.col("a_warns") & ~F.col("b_warns")
    newer = F.col("a_updates") & (F.col("a_time_key") > F.col("b_time_key"))
    edge = lambda kind, x, y, c, manual: F.struct(F.lit("claim_" + kind + "_claim" if not kind.startswith("deprecated") else "claim_" + kind).alias("kind"), F.col(x).alias("from_node"), F.col(y).alias("to_node"), F.lit(c).alias("confidence"), F.lit(manual).alias("manual_review_required"))
    edges = F.array_compact(F.array(
        F.when(against, edge("contextualizes", "a_claim_id", "b_claim_id", 0.55, False)),
        F.when(against & F.col("a_strong"), edge("contradicts", "a_claim_id", "b_claim_id", 0.52, True)),
        F.when(against & F.col("a_strong"), edge("deprecated_for_context", "b_claim_id", "a_claim_id", 0.5, True)),
        F.when(newer, edge("supersedes", "a_claim_id", "b_claim_id", 0.5, True)),
        F.when(newer & ~against, edge("contextualizes", "a_claim_id", "b_claim_id", 0.5, True)),
    ))
    return pairs.select(F.array_distinct(F.array("a_source_url", "b_source_url")).alias("source_urls"), F.explode(edges).alias("x")).select("x.*", "source_urls")


def cross_kinds(rows: DataFrame, of: DataFrame) -> DataFrame:
    """(source_url, kind, confidence): the sorts of relations between claims that name each address of a short list, of(source_url), once.

    These are the sorts of cross_edges(rows, of). Each related pair is looked at where it is found and only sorts are shuffled, a few for an address.
    """
    asked = F.broadcast(of.select("source_url").distinct())
    return _edges(_pairs(rows, of)).withColumn("source_url", F.explode("source_urls")).select("source_url", "kind", "confidence").join(asked, "source_url", "left_semi").distinct()


def claim_stats(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of counters over claims and the kinds of edges(kind, edges), the numbers of relations."""
    count = lambda c: F.count_if(c)
    sure = F.col("confidence")
    of_claims = rows.agg(F.count("*").alias("claim_count"), count(F.col("claim_kind") == "method").alias("method_count"), count(F.col("claim_kind") == "warning").alias("warning_count"), count(F.col("manual_review_required")).alias("manual_review_candidate_count"), count(sure >= 0.7).alias("high"), count((sure >= 0.5) & (sure < 0.7)).alias("medium"), count(sure < 0.5).alias("low"))
    contexts = rows.select(F.explode("applicability_context").alias("c")).agg(F.countDistinct("c").alias("applicability_context_count"))
    kind = F.col("kind")
    number = lambda when: F.coalesce(F.sum(F.when(when, F.col("edges"))), F.lit(0))
    of_edges = edges.agg(*[number(kind == f"claim_{k}_claim").alias(f"{k}_count") for k in ("supersedes", "contradicts", "contextualizes")], number(kind.isin("source_warns_about_claim", "warning_targets_object", "warning_targets_action")).alias("warning_relation_count"))
    return of_claims.crossJoin(contexts).crossJoin(of_edges)
