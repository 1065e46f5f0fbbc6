"""Audits of runs: states of information needs, the checks of coverage and refresh, and criteria of readiness.

A run is a chain of receipts, one for each stage: (chain, stage, receipt_id, run_id, profile_id, at, network_touched, errors, public_only,
internal_search, attachments, items); the newest of a stage counts. Pages are (chain, seed_id, page_start). Seeds, plans, needs and cases are
declared lists; what grows with the number of runs is aggregated by run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.operators.policy import Policy, allowed

STAGES = ("crawl", "normalize", "index", "vector", "graph")
#: Keys of a profile that name suites (fixed values).
SUITES = ("live_search_suite", "live_ranking_pressure_suite", "live_hybrid_query_suite", "live_graph_query_suite", "live_answer_suite", "claim_graph_suite", "claim_answer_suite")


def by_run(receipts: DataFrame) -> DataFrame:
    """(chain, crawl, normalize, index, vector, graph): the newest receipt of each stage as a struct, null where there is none."""
    fields = F.struct(*[c for c in receipts.columns if c not in ("chain", "stage")])
    newest = [F.max_by(fields, F.when(F.col("stage") == s, F.struct("at", "receipt_id"))).alias(s) for s in STAGES]
    return receipts.groupBy("chain").agg(*newest)


def need_states(wanted: DataFrame, seeds: DataFrame, pages: DataFrame, cases: DataFrame, chains: DataFrame) -> DataFrame:
    """(chain, need_id, for_ready, for_deep, status) of each need in each run.

    wanted: (need_id, seed_focus_any, eval_cases, eval_required, for_ready, for_deep); cases: (case_id) that exist. A need is missing_seed_focus
    without a seed of one of its focus areas, unmaterialized without a page of such a seed, missing_eval_route if it asks for cases
    and names none or one that doesn't exist, else covered.
    """
    focus = wanted.select("need_id", F.explode("seed_focus_any").alias("focus"))
    known = cases.select("case_id").distinct().withColumn("there", F.lit(1))
    named = wanted.select("need_id", F.explode("eval_cases").alias("case_id")).join(known, "case_id", "left")
    routes = named.groupBy("need_id").agg((F.count("there") == F.count("*")).alias("routed"))
    planned = focus.join(seeds.select("focus").distinct(), "focus").select("need_id").distinct().withColumn("planned", F.lit(True))
    needs = wanted.join(routes, "need_id", "left").join(planned, "need_id", "left")
    captured = pages.select("chain", "seed_id").distinct().join(seeds.select("seed_id", "focus"), "seed_id").select("chain", "focus").distinct()
    met = captured.join(focus, "focus").select("chain", "need_id").distinct().withColumn("met", F.lit(True))
    # Each need has a row in each run, so this product is the result's size.
    rows = chains.select("chain").distinct().crossJoin(needs).join(met, ["chain", "need_id"], "left")
    status = F.when(F.col("planned").isNull(), "missing_seed_focus").when(F.col("met").isNull(), "unmaterialized")
    status = status.when(F.coalesce("eval_required", F.lit(True)) & ~F.coalesce("routed", F.lit(False)), "missing_eval_route").otherwise("covered")
    return rows.select("chain", "need_id", F.coalesce("for_ready", F.lit(False)).alias("for_ready"), F.coalesce("for_deep", F.lit(True)).alias("for_deep"), status.alias("status"))


def need_summary(states: DataFrame) -> DataFrame:
    """(chain, covered, ready_required, ready_covered, deep_required, deep_covered, ready_complete, deep_complete)."""
    covered = F.col("status") == "covered"
    out = states.groupBy("chain").agg(
        F.count_if(covered).alias("covered"),
        F.count_if("for_ready").alias("ready_required"),
        F.count_if(F.col("for_ready") & covered).alias("ready_covered"),
        F.count_if("for_deep").alias("deep_required"),
        F.count_if(F.col("for_deep") & covered).alias("deep_covered"),
    )
    whole = lambda kind: (F.col(f"{kind}_required") > 0) & (F.col(f"{kind}_required") == F.col(f"{kind}_covered"))
    return out.withColumns({"ready_complete": whole("ready"), "deep_complete": whole("deep")})


def _of(stage: str, field: str) -> Column:
    return F.col(stage)[field]


def _every(stages: Sequence[str], test) -> Column:
    return F.forall(F.array(*[F.coalesce(test(s), F.lit(False)) for s in stages]), lambda x: x)


def _crawl_kept_policy() -> Column:
    return _of("crawl", "public_only") & ~_of("crawl", "internal_search") & ~_of("crawl", "attachments")


def _rows(wide: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    one = F.array(*[F.struct(F.lit(n).alias("check"), F.coalesce(c, F.lit(False)).alias("ok")) for n, c in checks.items()])
    return wide.select("chain", F.col("crawl").isNotNull().alias("crawled"), F.explode(one).alias("x")).select("chain", "crawled", "x.check", "x.ok")


def coverage_checks(receipts: DataFrame, pages: DataFrame, plan: DataFrame, seeds: DataFrame, suites: DataFrame, needs: DataFrame, profile: Mapping[str, object], rules: Policy = Policy()) -> DataFrame:
    """(chain, crawled, check, ok): the 16 checks of each run against a profile.

    plan: (seed_id, page_start); seeds: (seed_id, url); suites: (path) of suites that exist; needs: rows of need_summary. The profile is a mapping
    with profile_id, the paths of SUITES and of the information_need_matrix; an empty one doesn't exist.
    """
    expected = plan.select("seed_id", "page_start").distinct().withColumn("planned", F.lit(1))
    got = pages.select("chain", "seed_id", "page_start").distinct().join(F.broadcast(expected), ["seed_id", "page_start"], "left")
    got = got.groupBy("chain").agg(F.count("*").alias("fetched"), F.count("planned").alias("hit"))
    paths = [str(profile[k]) for k in SUITES if profile.get(k)]
    there = suites.where(F.col("path").isin(paths)).agg(F.countDistinct("path").alias("suites")) if paths else suites.agg(F.lit(0).alias("suites"))
    declared = expected.agg(F.count("*").alias("expected")).crossJoin(seeds.agg(F.count("*").alias("seeds"), F.bool_and(allowed(F.col("url"), rules)).alias("public"))).crossJoin(there)
    wide = by_run(receipts).join(got, "chain", "left").join(needs.select("chain", "deep_complete"), "chain", "left").crossJoin(F.broadcast(declared))
    runs = F.array(*[_of(s, "run_id") for s in STAGES])
    checks = {
        "profile_exists": F.lit(bool(profile)),
        "seed_file_exists": F.col("seeds") > 0,
        "seed_urls_allowed_public_topics": F.coalesce("public", F.lit(True)),
        "receipt_chain_present": _every(STAGES, lambda s: F.col(s).isNotNull()),
        "receipts_share_run": F.forall(runs, lambda r: F.coalesce(r, F.lit("")) != "") & (F.size(F.array_distinct(runs)) == 1),
        "receipt_profile_matches": _every(("crawl", "index", "vector", "graph"), lambda s: _of(s, "profile_id") == F.lit(profile.get("profile_id"))),
        "crawl_policy_preserved": _crawl_kept_policy(),
        "derived_stages_network_free": _every(STAGES[1:], lambda s: ~_of(s, "network_touched")),
        "all_expected_seed_pages_fetched": (F.col("expected") > 0) & (F.col("hit") == F.col("expected")),
        "normalized_pages_cover_fetched_pages": (F.col("fetched") > 0) & (F.coalesce(_of("normalize", "items"), F.lit(0)) >= F.col("fetched")),
        "index_has_docs": _of("index", "items") > 0,
        "vector_has_docs": _of("vector", "items") > 0,
        "graph_has_edges": _of("graph", "items") > 0,
        "quality_gate_suites_present": F.lit(len(paths) == len(SUITES)) & (F.col("suites") == len(set(paths))),
        "information_need_matrix_present": F.lit(bool(profile.get("information_need_matrix"))),
        "deep_information_needs_covered": F.col("deep_complete"),
    }
    return _rows(wide, checks)


def refresh_checks(receipts: DataFrame, now: DataFrame, coverage: DataFrame, max_age_hours: float = 168.0) -> DataFrame:
    """(chain, crawled, check, ok): the 9 checks of each run's age. now: one row with the clock; coverage: (chain, status) of coverage_states."""
    wide = by_run(receipts).join(coverage.select("chain", F.col("status").alias("coverage")), "chain", "left").crossJoin(F.broadcast(now.select("now")))
    at = {s: _of(s, "at") for s in STAGES}
    age = (F.col("now").cast("timestamp").cast("double") - at["crawl"].cast("double")) / 3600
    checks = {
        "receipt_chain_present": _every(STAGES, lambda s: F.col(s).isNotNull()),
        "crawl_finished_at_present": at["crawl"].isNotNull(),
        "crawl_age_within_limit": F.round(F.greatest(F.lit(0.0), age), 2) <= max_age_hours,
        "crawl_errors_zero": F.col("crawl").isNotNull() & (F.coalesce(_of("crawl", "errors"), F.lit(0)) == 0),
        "crawl_policy_preserved": _crawl_kept_policy(),
        "derived_stages_network_free": _every(STAGES[1:], lambda s: ~_of(s, "network_touched")),
        "derived_timestamps_present": _every(STAGES[1:], lambda s: at[s].isNotNull()),
        "derived_not_older_than_crawl": (at["normalize"] >= at["crawl"]) & (at["index"] >= at["normalize"]) & (at["vector"] >= at["normalize"]) & (at["graph"] >= at["normalize"]),
        "coverage_ready": F.col("coverage") == "coverage_ready",
    }
    return _rows(wide, checks)


def _states(checks: DataFrame, missing: str, ready: str, otherwise: str) -> DataFrame:
    out = checks.groupBy("chain").agg(F.bool_or("crawled").alias("crawled"), F.count_if(~F.col("ok")).alias("failed"))
    return out.select("chain", "failed", F.when(~F.col("crawled"), missing).when(F.col("failed") == 0, ready).otherwise(otherwise).alias("status"))


def coverage_states(checks: DataFrame) -> DataFrame:
    """(chain, failed, status): no_run, coverage_ready or partial."""
    return _states(checks, "no_run", "coverage_ready", "partial")


def refresh_states(checks: DataFrame) -> DataFrame:
    """(chain, failed, status): missing_run, fresh or needs_refresh."""
    return _states(checks, "missing_run", "fresh", "needs_refresh")


def criteria(checks: DataFrame, coverage: DataFrame, needs: DataFrame, review: DataFrame) -> DataFrame:
    """(chain, criterion, status): those criteria of readiness that depend on data, as achieved, partial or missing.

    checks: rows of coverage_checks; coverage: of coverage_states; needs: of need_summary; review: one row with the status of the seed review.
    """
    ok = lambda *names: F.bool_and(F.when(F.col("check").isin(*names), F.col("ok")))
    flags = checks.groupBy("chain").agg(
        ok("information_need_matrix_present").alias("matrix"),
        ok("receipts_share_run", "crawl_policy_preserved", "derived_stages_network_free", "index_has_docs", "vector_has_docs", "graph_has_edges").alias("chained"),
    )
    wide = flags.join(coverage.select("chain", F.col("status").alias("coverage")), "chain").join(needs.select("chain", "deep_complete"), "chain", "left").crossJoin(F.broadcast(review.select(F.col("status").alias("review"))))
    graded = {
        "seed_review": F.when(F.col("review") == "reviewed", "achieved").when(F.col("review").isin("missing_run", "missing_review", "needs_review", "reviewed_pending_seed_update"), "partial").otherwise("missing"),
        "coverage_state": F.when(F.col("coverage") == "coverage_ready", "achieved").when(F.col("coverage").isin("no_run", "partial"), "partial").otherwise("missing"),
        "information_needs": F.when(~F.col("matrix"), "missing").when(F.coalesce("deep_complete", F.lit(False)), "achieved").otherwise("partial"),
        "receipt_pipeline": F.when(F.col("chained"), "achieved").otherwise("partial"),
    }
    one = F.array(*[F.struct(F.lit(n).alias("criterion"), c.alias("status")) for n, c in graded.items()])
    return wide.select("chain", F.explode(one).alias("x")).select("chain", "x.criterion", "x.status")


def readiness(found: DataFrame) -> DataFrame:
    """(chain, achieved, partial, missing, status) of criteria: ready if all are achieved, else not_ready."""
    out = found.groupBy("chain").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("achieved", "partial", "missing")])
    return out.withColumn("status", F.when((F.col("partial") == 0) & (F.col("missing") == 0), "ready").otherwise("not_ready"))
