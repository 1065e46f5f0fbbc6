"""Audits of runs: one whole run, and runs that each break one thing."""

from datetime import datetime

from tracewell.operators import readiness as r

FIELDS = "chain string, stage string, receipt_id long, run_id string, profile_id string, at timestamp, network_touched boolean, errors int, public_only boolean, internal_search boolean, attachments boolean, items long"
SEED = "https://forum.example.org/index.php?showtopic=1&st=0"


def _receipt(chain, stage, **changed):
    row = {"chain": chain, "stage": stage, "receipt_id": 1, "run_id": "r", "profile_id": "p", "at": datetime(2026, 1, 1, 1 + r.STAGES.index(stage)), "network_touched": stage == "crawl", "errors": 0, "public_only": True, "internal_search": False, "attachments": False, "items": 5}
    return tuple({**row, **changed}.values())


def _audit(spark, receipts, pages, profile, suites=r.SUITES):
    receipts = spark.createDataFrame(receipts, FIELDS)
    pages = spark.createDataFrame(pages, "chain string, seed_id string, page_start string")
    seeds = spark.createDataFrame([("s1", SEED, "f1")], "seed_id string, url string, focus string")
    plan = spark.createDataFrame([("s1", "0"), ("s1", "20")], "seed_id string, page_start string")
    wanted = spark.createDataFrame([("n1", ["f1", "f2"], ["a"], None, True, None), ("n2", ["f2"], [], False, False, False), ("n3", ["f1"], ["a", "b"], True, True, False)], "need_id string, seed_focus_any array<string>, eval_cases array<string>, eval_required boolean, for_ready boolean, for_deep boolean")
    needs = r.need_states(wanted, seeds, pages, spark.createDataFrame([("a",)], "case_id string"), receipts)
    checks = r.coverage_checks(receipts, pages, plan, seeds, spark.createDataFrame([(s,) for s in suites], "path string"), r.need_summary(needs), profile)
    return receipts, needs, checks


def test_runs(spark):
    profile = {"profile_id": "p", "information_need_matrix": "m", **{s: s for s in r.SUITES}}
    broken = {
        "policy": ("crawl", {"attachments": True}, "crawl_policy_preserved"),
        "online": ("vector", {"network_touched": True}, "derived_stages_network_free"),
        "unknown": ("graph", {"network_touched": None}, "derived_stages_network_free"),
        "other": ("index", {"run_id": "r2"}, "receipts_share_run"),
        "profile": ("index", {"profile_id": "q"}, "receipt_profile_matches"),
        "empty": ("graph", {"items": 0}, "graph_has_edges"),
        "few": ("normalize", {"items": 1}, "normalized_pages_cover_fetched_pages"),
    }
    receipts = [_receipt(c, s, **(broken[c][1] if c in broken and broken[c][0] == s else {})) for c in ("whole", *broken, "unread") for s in r.STAGES]
    receipts += [_receipt("nocrawl", s) for s in r.STAGES[1:]]
    receipts += [_receipt("whole", "graph", receipt_id=0, items=0, at=datetime(2025, 1, 1))]  # an older one doesn't count
    pages = [(c, "s1", st) for c in ("whole", "nocrawl", *broken) for st in ("0", "20", "20")] + [("unread", "s1", "0")]
    given, needs, checks = _audit(spark, receipts, pages, profile)
    failed = {}
    for row in checks.where("NOT ok").collect():
        failed.setdefault(row["chain"], set()).add(row["check"])
    assert checks.count() == 16 * (len(broken) + 3)
    assert "whole" not in failed
    assert {c: failed[c] for c in broken} == {c: {b[2]} for c, b in broken.items()}
    assert failed["unread"] == {"all_expected_seed_pages_fetched"}
    states = {x["chain"]: x["status"] for x in r.coverage_states(checks).collect()}
    assert states.pop("whole") == "coverage_ready" and states.pop("nocrawl") == "no_run" and set(states.values()) == {"partial"}
    assert {x["need_id"]: x["status"] for x in needs.where("chain = 'whole'").collect()} == {"n1": "covered", "n2": "missing_seed_focus", "n3": "missing_eval_route"}
    now = spark.createDataFrame([(datetime(2026, 1, 8, 1),)], "now timestamp")
    aged = lambda hours: {x["chain"]: x["status"] for x in r.refresh_states(r.refresh_checks(given, now, r.coverage_states(checks), hours)).collect()}
    assert aged(168.0)["whole"] == "fresh" and aged(167.9)["whole"] == "needs_refresh"
    assert aged(168.0)["nocrawl"] == "missing_run" and aged(168.0)["policy"] == "needs_refresh"
    for review, said in (("reviewed", "ready"), ("needs_review", "not_ready"), ("error", "not_ready")):
        found = r.criteria(checks, r.coverage_states(checks), r.need_summary(needs), spark.createDataFrame([(review,)], "status string"))
        out = {x["chain"]: x for x in r.readiness(found).collect()}
        assert out["whole"]["status"] == said and out["whole"]["missing"] == (review == "error")
        assert out["empty"]["status"] == "not_ready"


def test_no_profile_and_no_runs(spark):
    _, needs, checks = _audit(spark, [_receipt("c", s) for s in r.STAGES], [], {}, ())
    failed = {x["check"] for x in checks.where("NOT ok").collect()}
    assert {"profile_exists", "quality_gate_suites_present", "information_need_matrix_present", "deep_information_needs_covered", "receipt_profile_matches"} <= failed
    assert {x["status"] for x in needs.collect()} == {"unmaterialized", "missing_seed_focus"}
    _, needs, checks = _audit(spark, [], [], {"profile_id": "p"})
    assert needs.count() == 0 and checks.count() == 0
