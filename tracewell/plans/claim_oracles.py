"""DuckDB SQL of claims, their relations, reranking and answers."""

from __future__ import annotations

from collections.abc import Callable

from tracewell.operators import answers as A
from tracewell.operators import retrieval as G


#: The text around the first of the places ps, c being the first one from 0.
SNIPPET = """CASE WHEN len(ps) = 0 THEN substr(text, 1, 500) ELSE (CASE WHEN c - 190 > 0 THEN '...' ELSE '' END) || trim(substr(text, greatest(0, c - 190) + 1, least(length(text), c + 190) - greatest(0, c - 190)), ' ') || (CASE WHEN c + 190 < length(text) THEN '...' ELSE '' END) END"""


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(words: list[str]) -> str:
    return "(" + ", ".join(map(_q, words)) + ")"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(map(_q, words)) + "]"


def _has(c: str, words: list[str]) -> str:
    return f"len(list_filter({_list(words)}, lambda w: contains({c}, w))) > 0"


def _slug(c: str) -> str:
    return f"coalesce(nullif(regexp_replace(regexp_replace(lower({c}), '[^a-z0-9а-яё]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'unknown')"


def _of(*kinds: str, label: str = "") -> str:
    inside = f" AND contains(lower({label}), lower(x.v))" if label else ""
    return f"list_transform(list_filter(ents, lambda x: x.k IN {_in(list(kinds))}{inside}), lambda x: x.v)"


def _set(c: str) -> str:
    return f"list_sort(list_distinct({c}))"


def _either(a: str, b: str) -> str:
    return _set(f"CASE WHEN len({a}) > 0 THEN {a} ELSE {b} END")


def _labels(pairs: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {test} THEN {_q(name)} END" for test, name in pairs) + "], lambda x: x IS NOT NULL)"


def claim_ctes(entity_base: str, R) -> str:
    """CTEs p (posts), c (claims) and cw (claims with their windows)."""
    after = _has("low", ["после обнов", "after update"])
    context = _set(_of("device", "device_model", "codename", "firmware_family", "firmware_version", "build_id") + " || " + _labels([(_has("low", ["global", "глобал"]), "region:global"), (_has("low", ["eea", "europe", "европ"]), "region:eea"), (_has("low", ["china", "китай"]), "region:china"), (after, "after_update")]))
    condition = _set(_labels([(f"{_has('low', ['bootloader', 'загрузчик'])} AND {_has('low', ['unlock', 'разблок'])}", "bootloader_unlocked"), ("contains(low, 'fastbootd')", "fastbootd_available"), (_has("low", ["matching", "родной", "стоковой прошивки"]), "matching_firmware_required")]))
    risk = _set(_of("issue") + " || " + _labels([(f"contains(low, 'fastbootd') AND {_has('low', ['кирпич', 'brick'])}", "brick_fastbootd"), (_has("low", ["не ставить", "do not install", "не прошивать"]), "unsafe_flash")]))
    status = f"CASE WHEN {_has('low', R.NEGATIVE_TERMS)} THEN 'no longer works for current context' WHEN {after} THEN 'after update context changes applicability' ELSE 'current update context' END"
    none = "[]::VARCHAR[]"
    tools = lambda *names: _set(f"list_filter({_of('tool')}, lambda t: t IN {_in(list(names))})" if names else _of("tool"))

    def branch(n: int, kind: str, method: str, labels: str, targets: str, own_tools: str, risks: str, warnings: str, confidence: str, manual: str, updates: str = "false") -> str:
        return f"SELECT *, {n} AS b, '{kind}' AS claim_kind, '{method}' AS method_kind, {targets} AS targets, {own_tools} AS tools, {risks} AS risks, {warnings} AS warnings, CAST({confidence} AS DOUBLE) AS confidence, {manual} AS manual, {updates} AS updates FROM (SELECT p.*, unnest({labels}) AS al FROM p)"

    branches = [
        branch(0, "method", "root", _of("root_action"), _either(_of("file", label="al"), _of("file")), tools("KSU", "Magisk"), "risk", "list_sort(list_distinct(warned))", "0.72", "review"),
        branch(1, "method", "recovery", _of("recovery_action"), _either(_of("file", label="al"), _of("file")), tools("OrangeFox", "TWRP", "fastboot"), "risk", "list_sort(list_distinct(warned))", "0.72", "review"),
        branch(2, "method", "issue_recovery", _of("fix"), _either(_of("file", "issue", label="al"), _of("file", "issue")), tools(), "risk", "list_sort(list_distinct(warned))", "0.62", "review"),
        branch(3, "warning", "risk_warning", f"CASE WHEN len(warned) = 0 AND {_has('low', R.WARNING_TERMS)} THEN [trim(substr(clean, greatest(1, first_term - 50), 220))] ELSE warned END", _either(_of("file", "codename", "device", "firmware_family", "firmware_version", "build_id", "tool", label="al"), _of("file", "codename", "firmware_family", "firmware_version")), tools(), "CASE WHEN len(risk) > 0 THEN risk ELSE ['unsafe_without_matching_context'] END", "[al]", "CASE WHEN len(warned) > 0 THEN 0.7 ELSE 0.55 END", "review OR len(warned) = 0"),
        branch(4, "status", "freshness_update", f"CASE WHEN {_has('low', R.UPDATE_TERMS + R.NEGATIVE_TERMS)} THEN [{status}] ELSE {none} END", _set(_of("file", "firmware_family", "firmware_version", "build_id")), tools(), "risk", none, "0.58", "true", "true"),
    ]
    lal = "lower(al)"
    action = f"CASE WHEN {_has(lal, ['restore', 'восстанов', 'верн'])} THEN 'restore' WHEN {_has(lal, ['patch', 'патч'])} THEN 'patch' WHEN {_has(lal, ['flash', 'прош', 'install'])} THEN 'flash' WHEN {_has(lal, ['no longer', 'не работает'])} THEN 'status_update' WHEN {_has(lal, R.WARNING_TERMS)} THEN 'warn' ELSE {_slug('al')} END"
    part = lambda name, c: f"CASE WHEN len({c}) > 0 THEN '{name}' || array_to_string({c}[1:3], ', ') END"
    keyed = lambda c: f"array_to_string(list_sort(list_transform({c}, lambda x: {_slug('x')})), '|')"
    return f"""ent AS (WITH {entity_base} SELECT * FROM e),
post AS (WITH {entity_base} SELECT key, doc_id, topic_id, text, low FROM d),
el AS (SELECT key, list({{'k': kind, 'v': value}}) AS ents FROM ent GROUP BY key),
p0 AS (SELECT post.*, coalesce(ents, []) AS ents, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS clean, 'https://forum.example.org/index.php?showtopic=' || topic_id || '&st=0#entry' || key AS url, '2021-' || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') || '-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS posted FROM post LEFT JOIN el USING (key)),
p AS (SELECT *, {context} AS context, {condition} AS condition, {risk} AS risk, {_has("low", R.REVIEW_TERMS)} AS review, {_of("warning")} AS warned, list_min(list_filter(list_transform({_list(R.WARNING_TERMS)}, lambda t: strpos(lower(clean), t)), lambda x: x > 0)) AS first_term FROM p0),
c0 AS ({" UNION ALL ".join(branches)}),
c1 AS (SELECT *, {action} AS action, concat_ws(' | ', nullif(al, ''), {part("targets ", "targets")}, {part("uses ", "tools")}, {part("context ", "context")}) AS label FROM c0),
c2 AS (SELECT *, 'method:starter:' || {_slug("method_kind")} || ':' || {_slug("action")} || ':' || {_slug("CASE WHEN len(targets) > 0 AND array_to_string(targets, '_') <> '' THEN array_to_string(targets, '_') ELSE al END")} AS method_id,
 'claim:starter:' || key || ':' || claim_kind || ':' AS head, {_slug("action")} || ':' || {keyed("targets")} || ':' || {keyed("tools")} AS relation_key, CAST(greatest(strpos(lower(clean), lower(al)) - 1, 0) AS INTEGER) AS evidence_start FROM c1),
c3 AS (SELECT *, CASE WHEN length(head || {_slug("label")}) > 140 THEN head || substr(sha256(label), 1, 16) ELSE head || {_slug("label")} END AS claim_id FROM c2),
c AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY key, claim_id ORDER BY b) AS n FROM c3) WHERE n = 1),
cw AS (SELECT *, (SELECT count(*) FROM c o WHERE o.relation_key = x.relation_key AND (o.posted, o.doc_id) > (x.posted, x.doc_id)) AS newer_related_count, row_number() OVER (ORDER BY posted, doc_id, claim_id) - 1 AS i, count(*) OVER () AS total FROM c x)"""


def _edges(R) -> str:
    """CTEs ce (edges of claims) and xe (edges between claims, with both addresses)."""
    name = lambda prefix, c: f"'{prefix}:' || {_slug(c)}"
    one = lambda kind, a, b, conf, when="true": f"SELECT {kind} AS kind, {a} AS f, {b} AS t, key, url, CAST({conf} AS DOUBLE) AS confidence FROM c WHERE {when}"
    many = lambda kind, a, c, prefix, conf, when="true": f"SELECT '{kind}', {a}, {name(prefix, 'x')}, key, url, {conf} FROM (SELECT *, unnest({c}) AS x FROM c) WHERE {when}"
    warns = "claim_kind = 'warning'"
    parts = [
        one(f"CASE WHEN {warns} THEN 'source_warns_about_claim' ELSE 'source_supports_claim' END", "'post:' || key", "claim_id", "confidence"),
        one("'source_updates_claim'", "'post:' || key", "claim_id", 0.55, "claim_kind = 'status'"),
        one("'post_mentions_claim'", "'post:' || key", "claim_id", "confidence"),
        one("'claim_applies_to_context'", "claim_id", name("action", "action"), 0.55),
        many("claim_applies_to_context", "claim_id", "context", "context", 0.55),
        one("'claim_refines_claim'", "claim_id", "method_id", 0.45),
        many("method_uses_tool", "method_id", "tools", "tool", 0.6),
        many("method_targets_object", "method_id", "targets", "target", 0.65),
        many("method_requires_condition", "method_id", "condition", "condition", 0.5),
        many("warning_targets_object", "claim_id", "targets", "target", 0.62, warns),
        one("'warning_targets_action'", "claim_id", name("action", "action"), 0.55, warns),
    ]
    strong = _has("lower(array_to_string(warnings, ' ') || ' ' || label)", R.WARNING_TERMS + R.NEGATIVE_TERMS)
    updates = f"(updates OR {_has('lower(label)', R.UPDATE_TERMS + R.NEGATIVE_TERMS)})"
    edge = lambda kind, a, b, conf, manual, when: f"SELECT 'claim_{kind}' AS kind, {a} AS f, {b} AS t, CAST({conf} AS DOUBLE) AS confidence, {manual} AS manual, a_url, b_url FROM pairs WHERE {when}"
    return f"""ce AS (SELECT kind, f, t, key, min(url) AS url, max(confidence) AS confidence FROM ({" UNION ALL ".join(parts)}) GROUP BY kind, f, t, key),
sides AS (SELECT claim_id, key, url, posted, doc_id, {warns} AS warns, {strong} AS strong, {updates} AS upd, unnest(list_transform(targets, lambda x: 't:' || x) || ['k:' || relation_key]) AS k FROM c),
pairs AS (SELECT DISTINCT a.claim_id AS a, b.claim_id AS b, a.url AS a_url, b.url AS b_url, a.warns AND NOT b.warns AS against, a.strong AS strong, a.upd AND (a.posted, a.doc_id) > (b.posted, b.doc_id) AS newer FROM sides a JOIN sides b USING (k) WHERE a.key <> b.key AND ((a.warns AND NOT b.warns) OR (a.upd AND (a.posted, a.doc_id) > (b.posted, b.doc_id)))),
xe AS ({" UNION ALL ".join([edge("contextualizes_claim", "a", "b", 0.55, "false", "against"), edge("contradicts_claim", "a", "b", 0.52, "true", "against AND strong"), edge("deprecated_for_context", "b", "a", 0.5, "true", "against AND strong"), edge("supersedes_claim", "a", "b", 0.5, "true", "newer"), edge("contextualizes_claim", "a", "b", 0.5, "true", "newer AND NOT against")])})"""


def rank_ctes(relation_pairs: str, most: int = 10) -> str:
    """CTEs that go on from keyword search: found, ctx (relations of results), rr (reranked), gr (grounded), ch (the chain)."""
    plain = lambda c: f"translate(lower({c}), '_-', '  ')"
    said = plain("CASE WHEN regexp_matches(kind, '_(uses_tool|targets_file|targets_object|mentions_firmware)$') THEN t ELSE concat_ws(' ', kind, f, t) END")
    near = "(starts_with(f, 'entity:') OR starts_with(f, 'claim:') OR starts_with(t, 'claim:') OR starts_with(f, 'post:'))"
    content = lambda c: f"list_distinct(list_filter(list_transform({c}, lambda x: lower(trim(x))), lambda x: length(x) >= 3 AND x NOT IN {_in(A.DEVICE_WORDS + A.WEAK_WORDS)}))"
    any_kind = lambda names: f"list_has_any(kinds, {_list(names)})"
    pick = lambda when, c: f"coalesce(list_sort(list_distinct(list({c}) FILTER ({when}))), [])"
    val = lambda c: f"regexp_extract({c}, '^entity:[^:]*:(.*)$', 1)"
    clause = lambda name, c: f"CASE WHEN len({c}) > 0 THEN '{name}: ' || array_to_string({c}, '; ') || '.' END"
    return f"""ed AS (SELECT url, kind, f, t, confidence FROM ce UNION ALL SELECT a_url, kind, f, t, confidence FROM xe UNION ALL SELECT b_url, kind, f, t, confidence FROM xe
 UNION ALL SELECT p.url, r.kind, from_node, to_node, confidence FROM (SELECT DISTINCT * FROM ({relation_pairs})) r JOIN p ON p.key = r.post_id),
found AS (SELECT ranked.*, url FROM ranked JOIN p USING (key) WHERE rank <= {most}),
ctx AS (SELECT query_id, found.key, kind, f, t, ed.confidence FROM found JOIN ed USING (url) WHERE {near}),
vals AS (SELECT query_id, list(DISTINCT v) AS vs FROM (SELECT query_id, {plain("x")} AS v FROM (SELECT query_id, term AS x FROM qe UNION ALL SELECT query_id, term FROM sp UNION ALL SELECT query_id, unnest(r) FROM q) UNION ALL SELECT query_id, {plain("term")} FROM qt WHERE {plain("term")} IN {_in(G.PLAIN_TERMS)}) WHERE length(v) >= 3 GROUP BY query_id),
it AS (SELECT query_id, list_has_any(t, {_list(G.ROOT_TERMS)}) AS root, list_has_any(t, {_list(G.RECOVERY_TERMS)}) AS recovery, coalesce(vs, []) AS vs, {content("t")} AS content, list_has_any(t, {_list(A.WARNING_WORDS)}) AS warning_requested FROM q LEFT JOIN vals USING (query_id)),
es AS (SELECT query_id, list(DISTINCT term) AS exact_terms FROM qe GROUP BY query_id),
m AS (SELECT query_id, key, count(*) AS matching_edge_count, count(DISTINCT kind) AS matching_kinds, round(sum(confidence), 6) AS matching_confidence FROM ctx JOIN it USING (query_id) WHERE ((root AND kind IN {_in(G.ROOT_KINDS)}) OR (recovery AND kind IN {_in(G.RECOVERY_KINDS)})) AND (len(vs) = 0 OR len(list_filter(vs, lambda v: contains({said}, v))) > 0) GROUP BY query_id, key),
r0 AS (SELECT found.*, round(total, 6) AS score, coalesce(matching_edge_count, 0) AS mc, coalesce(matching_kinds, 0) AS mk, coalesce(matching_confidence, 0.0) AS mf, root OR recovery AS asked, content, warning_requested, list_filter({content("coalesce(exact_terms, [])")}, lambda x: regexp_matches(x, '[0-9]') AND regexp_matches(x, '[a-zа-яё]')) AS structured FROM found JOIN it USING (query_id) LEFT JOIN m USING (query_id, key) LEFT JOIN es USING (query_id)),
rr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN asked THEN mc END DESC, CASE WHEN asked THEN mk END DESC, CASE WHEN asked THEN mf END DESC, CASE WHEN asked THEN len(mx) END DESC, CASE WHEN asked THEN len(me) END DESC, CASE WHEN asked THEN score END DESC, rank) AS graph_rank, CASE WHEN mc > 0 THEN round(0.4 * (least(mc, 2) / 2) + 0.4 * (least(mk, 2) / 2) + 0.2 * least(mf, 1.0), 6) ELSE 0.0 END AS graph_raw FROM r0),
ck AS (SELECT query_id, key, list_sort(list(DISTINCT kind)) AS kinds, list_distinct(list(f) || list(t)) AS nodes FROM ctx GROUP BY query_id, key),
g0 AS (SELECT rr.*, coalesce(kinds, []) AS kinds, coalesce(nodes, []) AS nodes, list_distinct(mt || me || flatten(list_transform(mpl, lambda x: string_split(x, ' '))) || mpl) AS matched FROM rr LEFT JOIN ck USING (query_id, key)),
g1 AS (SELECT *, len(list_intersect(content, matched)) AS matched_count, len(list_filter(structured, lambda x: NOT list_contains(matched, x))) AS unmatched_structured, CASE WHEN asked THEN mc > 0 ELSE {any_kind(["fixes_issue", "warns_about", "warning_targets_object"])} END AS relation_supported, {any_kind(A.WARNING_KINDS)} AS warning_supported FROM g0),
gr AS (SELECT *, CASE WHEN warning_requested AND NOT warning_supported THEN false WHEN unmatched_structured > 0 THEN matched_count >= 3 WHEN relation_supported THEN true WHEN len(content) >= 5 THEN matched_count >= 3 WHEN matched_count >= 2 THEN true ELSE matched_count >= 1 AND len(list_filter(mpl, lambda x: list_has_any(string_split(x, ' '), content))) > 0 END AS grounded FROM g1),
ch0 AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY graph_rank) AS step FROM gr WHERE grounded),
en AS (SELECT key, {pick("kind = 'issue'", "value")} AS issues, {pick("kind = 'root_action'", "value")} AS roots, {pick("kind = 'recovery_action'", "value")} AS recoveries FROM ent GROUP BY key),
cx AS (SELECT query_id, key, {pick("kind = 'fixes_issue'", val("f"))} AS fixes, {pick("kind = 'warns_about'", val("f"))} AS warnings, {pick("kind = 'warns_about'", val("t"))} AS warned, {pick("kind LIKE '%_targets_file' AND t LIKE 'entity:file:%'", val("t"))} AS files, {pick("kind LIKE '%_uses_tool' AND t LIKE 'entity:tool:%'", val("t"))} AS tools, {pick("kind LIKE '%_mentions_firmware' AND regexp_matches(t, '^entity:(build_id|firmware_family|firmware_version):')", val("t"))} AS firmware, min(confidence) AS min_confidence FROM ctx GROUP BY query_id, key),
own AS (SELECT key, list_sort(list(DISTINCT claim_id)) AS claim_ids, list_sort(list_distinct(flatten(list(context)))) AS contexts, list_sort(list_distinct(flatten(list(condition)))) AS conditions, list_sort(list(DISTINCT CASE WHEN i = total - 1 THEN 'latest_window' WHEN i * 3 < total THEN 'early' WHEN i * 3 < 2 * total THEN 'middle' ELSE 'late' END)) AS windows, list_distinct(flatten(list(targets) FILTER (claim_kind = 'warning'))) AS warning_targets FROM cw GROUP BY key),
ch1 AS (SELECT ch0.* EXCLUDE (kinds), kinds, coalesce(issues, []) AS issues, coalesce(roots, []) AS roots, coalesce(recoveries, []) AS recoveries, coalesce(fixes, []) AS fixes, coalesce(warnings, []) AS warnings, list_sort(list_distinct(coalesce(warned, []) || coalesce(warning_targets, []))) AS warned_targets, coalesce(files, []) AS files, coalesce(tools, []) AS tools, coalesce(firmware, []) AS firmware, min_confidence, coalesce(claim_ids, []) AS claim_ids, coalesce(contexts, []) AS contexts, coalesce(conditions, []) AS conditions, coalesce(windows, []) AS windows
 FROM ch0 LEFT JOIN en USING (key) LEFT JOIN cx USING (query_id, key) LEFT JOIN own USING (key)),
ch AS (SELECT *, CASE WHEN step = 1 THEN 'primary' WHEN {any_kind(A.CONFLICT)} THEN 'conflicting' WHEN {any_kind(A.SUPERSEDED)} THEN 'superseding' WHEN {any_kind(A.CONTEXT)} THEN 'contextual' WHEN len(warnings) > 0 THEN 'caution' WHEN len(kinds) > 0 THEN 'supporting' ELSE 'related_context' END AS role,
 CASE WHEN len(issues) > 0 AND len(fixes) > 0 AND len(warnings) > 0 THEN 'issue_fix_warning' WHEN len(issues) > 0 AND len(fixes) > 0 THEN 'issue_fix' WHEN len(warnings) > 0 THEN 'warning' WHEN len(roots) > 0 AND len(recoveries) > 0 THEN 'root_recovery' WHEN len(roots) > 0 THEN 'root' WHEN len(recoveries) > 0 THEN 'recovery' ELSE 'snippet' END AS answer_kind,
 concat_ws(' ', {clause("Issue", "issues")}, {clause("Suggested fixes", "fixes")}, CASE WHEN len(warnings) > 0 THEN 'Warnings: ' || array_to_string(warnings, '; ') || CASE WHEN len(warned_targets) > 0 THEN ' (about: ' || array_to_string(warned_targets, '; ') || ')' ELSE '' END || '.' END, {clause("Root actions", "roots")}, {clause("Recovery actions", "recoveries")}, {clause("Target files", "files")}, {clause("Tools", "tools")}, {clause("Firmware context", "firmware")}) AS said FROM ch1),
texts AS (SELECT ch.*, d.text AS own_text, list_filter(list_transform(me || mt, lambda x: position(lower(x) IN lower(d.text))), lambda x: x > 0) AS ps FROM ch JOIN d USING (key)),
answered AS (SELECT texts.* EXCLUDE (text), coalesce(nullif(said, ''), trim(snippet)) AS answer_text FROM (SELECT *, {SNIPPET} AS snippet FROM (SELECT *, own_text AS text, list_min(ps) - 1 AS c FROM texts)) texts)"""


def build(entity_base: str, relation_pairs: str, keyword: str, dots: str, R) -> dict[str, str]:
    claims = claim_ctes(entity_base, R)
    edges = _edges(R)
    joined = ", ".join(f"array_to_string({c}, '|') AS {n}" for c, n in (("targets", "target_labels"), ("tools", "tool_labels"), ("condition", "condition_labels"), ("context", "applicability_context"), ("risks", "risk_labels"), ("warnings", "warning_labels")))
    ranked = f"WITH {keyword}, {claims}, {edges}, {rank_ctes(relation_pairs.replace('FROM e a JOIN e b', 'FROM ent a JOIN ent b'))}"
    any_kind: Callable = lambda names: f"list_has_any(kinds, {_list(names)})"
    count = lambda k: f"count(*) FILTER (kind = 'claim_{k}_claim') AS {k}_count"
    label_sql = ", ".join(f"array_to_string({c}, '|') AS {n}" for c, n in (("issues", "issue_labels"), ("fixes", "fix_labels"), ("warnings", "warning_labels"), ("warned_targets", "warned_target_labels"), ("roots", "root_action_labels"), ("recoveries", "recovery_action_labels"), ("files", "target_file_labels"), ("tools", "tool_labels"), ("firmware", "firmware_context_labels"), ("claim_ids", "claim_ids"), ("contexts", "claim_context_labels"), ("conditions", "claim_condition_labels"), ("windows", "windows")))
    many = lambda c, kind, prefix, conf: f"SELECT '{prefix}:' || {_slug('x')}, '{kind}', x, url, {conf} FROM (SELECT url, unnest({c}) AS x FROM c)"
    nodes = f"""cn AS (SELECT node_id, min(kind) AS kind, min(label) AS label, count(DISTINCT url) AS refs, max(confidence) AS confidence FROM (
 SELECT claim_id AS node_id, 'claim' AS kind, label, url, confidence FROM c UNION ALL SELECT method_id, 'method', method_kind || ' ' || action, url, 0.65 FROM c UNION ALL SELECT 'action:' || {_slug("action")}, 'action', action, url, 0.65 FROM c
 UNION ALL {many("targets", "target", "target", 0.65)} UNION ALL {many("tools", "tool", "tool", 0.65)} UNION ALL {many("condition", "condition", "condition", 0.6)} UNION ALL {many("context", "applicability_context", "context", 0.6)} UNION ALL {many("risks", "risk", "risk", 0.6)}
 UNION ALL SELECT 'warning:' || substr({_slug("x")}, 1, 60) || ':' || substr(sha256(x), 1, 12), 'warning', x, url, 0.65 FROM (SELECT url, unnest(warnings) AS x FROM c)) GROUP BY node_id)"""
    graph = """gn AS (SELECT 'topic' AS kind, count(DISTINCT topic_id) AS n, 0 AS refs, 1.0 * count(DISTINCT topic_id) AS conf FROM post UNION ALL SELECT 'post', count(*), count(*), 1.0 * count(*) FROM post UNION ALL SELECT kind, count(DISTINCT value), count(DISTINCT value || ' ' || key), 0.6 * count(DISTINCT value) FROM ent GROUP BY kind)"""
    per_query = f"""{ranked}, cq AS (SELECT query_id, list_distinct(flatten(list(kinds))) AS kinds, count(*) AS cited FROM ch GROUP BY query_id),
cr AS (SELECT query_id, n, CASE WHEN n > 0 THEN 'answered' ELSE 'insufficient_evidence' END AS answer_status, CASE WHEN n = 0 THEN 'insufficient_evidence' WHEN {any_kind(A.CONFLICT)} THEN 'conflict_detected' WHEN {any_kind(A.SUPERSEDED)} THEN 'possibly_superseded' WHEN {any_kind(A.CONTEXT)} THEN 'contextualized' ELSE 'clear' END AS conflict_status, coalesce(cited, 0) AS cited, CASE WHEN n = 0 THEN CASE WHEN open > 0 THEN 'unmatched_structured_query_terms' ELSE 'candidate_evidence_below_grounding_threshold' END END AS gap_reason, total_ AS candidates
FROM (SELECT query_id, count(*) AS total_, count(*) FILTER (grounded) AS n, arg_min(unmatched_structured, graph_rank) AS open FROM gr GROUP BY query_id) LEFT JOIN cq USING (query_id))"""
    every = lambda c: f"coalesce(list_sort(list_distinct(flatten(list({c})))), [])"
    reported = f"""{per_query},
st AS (SELECT query_id, count(*) AS chain_step_count, count(DISTINCT p.topic_id) AS topic_count, count(DISTINCT ch.url) AS source_count, list_sort(list(DISTINCT answer_kind)) AS answer_kinds, {every("kinds")} AS relation_kinds, '2026-01-01T00:00:00Z' AS latest_captured_at, {every("windows")} AS profile_windows, {every("firmware || contexts")} AS context_labels, {every("conditions")} AS condition_labels, {every("warnings")} AS warning_labels, {every("warned_targets")} AS warning_target_labels FROM ch JOIN p USING (key) GROUP BY query_id),
wr AS (SELECT query_id, count(*) AS warning_relation_count FROM (SELECT DISTINCT query_id, kind, f, t FROM ctx SEMI JOIN ch USING (query_id, key) WHERE kind IN {_in(A.WARNING_KINDS[1:])}) GROUP BY query_id),
rp AS (SELECT *, CASE WHEN steps = 0 THEN 'not_enough_local_evidence' WHEN conflict_status = 'conflict_detected' THEN 'conflicting_evidence' WHEN conflict_status = 'possibly_superseded' THEN 'possibly_superseded' WHEN list_contains(pw, 'latest_window') THEN 'fresh_answer' WHEN conflict_status = 'contextualized' THEN 'old_with_newer_context' ELSE 'old_but_still_supported' END AS freshness_state, len(wl) > 0 OR wc > 0 AS warning_supported
 FROM (SELECT *, coalesce(chain_step_count, 0) AS steps, coalesce(profile_windows, []) AS pw, coalesce(warning_labels, []) AS wl, coalesce(warning_relation_count, 0) AS wc FROM cr LEFT JOIN st USING (query_id) LEFT JOIN wr USING (query_id) JOIN (SELECT query_id, query, list_has_any(t, {_list(A.WARNING_WORDS)}) AS warning_requested FROM q) USING (query_id)))"""
    flat = lambda c: f"array_to_string(coalesce({c}, []), '|') AS {c}"
    return {
        "claim_rows": f"WITH {claims} SELECT claim_id, claim_kind, method_id, action, label, {joined}, key AS post_id, confidence, manual AS manual_review_required, relation_key, CASE WHEN i = total - 1 THEN 'latest_window' WHEN i * 3 < total THEN 'early' WHEN i * 3 < 2 * total THEN 'middle' ELSE 'late' END AS profile_window, newer_related_count, evidence_start FROM cw",
        "claim_kinds": f"WITH {claims} SELECT claim_kind, method_kind, action, confidence, count(*) AS n, count(*) FILTER (manual) AS manual FROM c GROUP BY ALL",
        "claim_edges": f"WITH {claims}, {edges} SELECT kind, count(*) AS edges, round(sum(confidence), 4) AS confidence FROM ce GROUP BY kind",
        "claim_cross_edges": f"WITH {claims}, {edges} SELECT kind, confidence, manual AS manual_review_required, count(*) AS edges, min(f) AS first FROM xe GROUP BY ALL",
        "claim_stats": f"""WITH {claims}, {edges}, k AS (SELECT kind FROM ce UNION ALL SELECT kind FROM xe)
SELECT a.*, b.*, d.* FROM (SELECT count(*) AS claim_count, count(*) FILTER (claim_kind = 'method') AS method_count, count(*) FILTER (claim_kind = 'warning') AS warning_count, count(*) FILTER (manual) AS manual_review_candidate_count, count(*) FILTER (confidence >= 0.7) AS high, count(*) FILTER (confidence >= 0.5 AND confidence < 0.7) AS medium, count(*) FILTER (confidence < 0.5) AS low FROM c) a,
(SELECT count(DISTINCT x) AS applicability_context_count FROM (SELECT unnest(context) AS x FROM c)) b, (SELECT {", ".join(map(count, ("supersedes", "contradicts", "contextualizes")))}, count(*) FILTER (kind IN ('source_warns_about_claim', 'warning_targets_object', 'warning_targets_action')) AS warning_relation_count FROM k) d""",
        "graph_search": f"{ranked} SELECT query_id, CAST(graph_rank AS INTEGER) AS graph_rank, CAST(rank AS INTEGER) AS rank, key, score, mc AS matching_edge_count, mk AS matching_kinds, CAST(mf AS DOUBLE) AS matching_confidence, CAST(graph_raw AS DOUBLE) AS graph_raw FROM rr",
        "graph_hybrid_search": f"""WITH {keyword}, {dots}, {claims}, {edges}, {rank_ctes(relation_pairs.replace("FROM e a JOIN e b", "FROM ent a JOIN ent b"), 80)},
hb AS (SELECT coalesce(k.query_id, x.query_id) AS query_id, coalesce(k.key, x.key) AS key, coalesce(k.score, 0) AS kr, coalesce(x.score, 0) AS vs, coalesce(k.graph_raw, 0) AS gw, k.graph_rank AS keyword_rank, x.rank AS vector_rank FROM rr k FULL JOIN (SELECT * FROM vr WHERE rank <= 80) x ON k.query_id = x.query_id AND k.key = x.key),
hs AS (SELECT *, coalesce(gw / nullif(max(gw) OVER w, 0), 0) AS gn, round(0.65 * coalesce(kr / nullif(max(kr) OVER w, 0), 0) + 0.35 * coalesce(vs / nullif(max(vs) OVER w, 0), 0) + 0.85 * coalesce(gw / nullif(max(gw) OVER w, 0), 0), 6) AS score FROM hb WINDOW w AS (PARTITION BY query_id)),
hr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, round(gn, 6) DESC, coalesce(keyword_rank, 999999), coalesce(vector_rank, 999999), kr DESC, vs DESC, key) AS place FROM hs)
SELECT query_id, CAST(place AS INTEGER) AS rank, key, score, CAST(keyword_rank AS INTEGER) AS keyword_rank, CAST(vector_rank AS INTEGER) AS vector_rank, CAST(round(gn, 6) AS DOUBLE) AS graph_normalized FROM hr WHERE place <= 10""",
        "grounding": f"{ranked} SELECT query_id, CAST(graph_rank AS INTEGER) AS graph_rank, key, CAST(matched_count AS INTEGER) AS matched_count, CAST(unmatched_structured AS INTEGER) AS unmatched_structured, relation_supported, warning_requested, warning_supported, grounded FROM gr",
        "evidence_chain": f"{ranked} SELECT query_id, CAST(step AS INTEGER) AS step, key AS post_id, role, answer_kind, array_to_string(kinds, '|') AS relation_kinds FROM ch",
        "conflict_report": f"{per_query} SELECT query_id, answer_status, conflict_status, cited, gap_reason FROM cr",
        "answer_labels": f"{ranked} SELECT query_id, CAST(step AS INTEGER) AS step, key AS post_id, answer_text, min_confidence, {label_sql} FROM answered",
        "claim_nodes": f"WITH {claims}, {nodes} SELECT node_id, kind, label, refs, confidence FROM cn",
        "merged_nodes": f"WITH {claims}, {nodes}, {graph} SELECT kind, CAST(sum(n) AS BIGINT) AS nodes, CAST(sum(refs) AS BIGINT) AS refs, CAST(round(sum(conf), 4) AS DOUBLE) AS confidence FROM (SELECT kind, n, refs, conf FROM gn UNION ALL SELECT kind, count(*), sum(refs), sum(confidence) FROM cn GROUP BY kind) GROUP BY kind",
        "conflict_claims": f"""{ranked}, cc AS (SELECT DISTINCT query_id, CASE WHEN kind IN {_in(A.CONFLICT)} THEN 'conflicting' WHEN kind IN {_in(A.SUPERSEDED)} THEN 'superseding' WHEN kind IN {_in(A.CONTEXT)} THEN 'contextual' END AS role, unnest([f, t]) AS claim_id FROM ctx SEMI JOIN ch USING (query_id, key))
SELECT query_id, role, count(*) AS claims, min(claim_id) AS first_claim FROM cc WHERE role IS NOT NULL AND starts_with(claim_id, 'claim:') GROUP BY query_id, role""",
        "answer_reports": f"""{reported} SELECT query_id, steps AS chain_step_count, coalesce(topic_count, 0) AS topic_count, coalesce(source_count, 0) AS source_count, candidates - n AS filtered_count, n - steps AS deduplicated_count, freshness_state, CASE WHEN steps = 0 OR (regexp_matches(lower(query), 'now|current|сейчас|актуаль|можно ли') AND len(coalesce(context_labels, [])) = 0) THEN 'context_required' ELSE 'context_available' END AS applicability_status, warning_requested, warning_supported, CASE WHEN warning_supported THEN 'warning_present' ELSE 'no_warning_claim_in_evidence' END AS risk_status, wc AS warning_relation_count,
 CASE WHEN steps = 0 THEN 'none' WHEN conflict_status = 'conflict_detected' THEN 'bounded_conflict_visible' WHEN list_contains(coalesce(relation_kinds, []), 'claim_supersedes_claim') THEN 'bounded_freshness_pressure_visible' WHEN steps >= 2 THEN 'supported_by_multiple_local_sources' ELSE 'single_grounded_source' END AS confidence, latest_captured_at, {", ".join(map(flat, ("answer_kinds", "relation_kinds", "profile_windows", "context_labels", "condition_labels", "warning_labels", "warning_target_labels")))} FROM rp""",
        "answer_briefs": f"""{reported}, ft AS (SELECT query_id, trim(regexp_replace(answer_text, '\\s+', ' ', 'g')) AS a FROM answered WHERE step = 1),
fs AS (SELECT query_id, regexp_replace(CASE WHEN length(a) > 260 THEN regexp_replace(regexp_replace(substr(a, 1, 260), ' [^ ]*$', ''), '[.,;: ]+$', '') || '...' ELSE a END, '\\.$', '') AS summary FROM ft),
rf AS (SELECT query_id, string_agg('[' || step || ']', ', ' ORDER BY step) AS refs FROM ch WHERE step > 1 GROUP BY query_id)
SELECT query_id, answer_status AS status, CASE WHEN answer_status = 'answered' THEN concat_ws(' ', 'По локальной базе: ' || summary || ' [1].', 'Дополнительный контекст: см. ' || refs || '.', 'Свежесть: последнее локальное сохранение источников ' || latest_captured_at || '.', 'Ограничения: ' || nullif(concat_ws('; ', CASE WHEN candidates - n > 0 THEN 'отфильтровано слабых кандидатов: ' || (candidates - n) END, CASE WHEN n - steps > 0 THEN 'схлопнуто дублей постов: ' || (n - steps) END), '') || '.', CASE WHEN conflict_status IN ('conflict_detected', 'possibly_superseded', 'contextualized') THEN 'Семантика claims: ' || conflict_status || '.' END, CASE WHEN warning_supported THEN 'Предупреждения/риски присутствуют в evidence.' END) ELSE gap_reason END AS brief
FROM rp LEFT JOIN fs USING (query_id) LEFT JOIN rf USING (query_id)""",
    }
