"""DuckDB SQL for the rows of the catalogue's queries, written on its own terms (lists, lambdas and CTEs)."""

from __future__ import annotations

from tracewell.functions import text as T
from tracewell.operators.corpus import DECORATIONS
from tracewell.plans import claim_oracles


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _aliases(c: str) -> str:
    low = f"lower({c})"
    parts = [f"CASE WHEN regexp_matches({low}, {_q(chr(92) + 'b' + s.replace('_', '[' + chr(92) + 's_-]+') + '[' + chr(92) + 's._-]+img' + chr(92) + 'b')}) THEN ['{s}.img'] ELSE []::VARCHAR[] END" for s in T.IMAGE_STEMS]
    parts.append(f"list_transform(regexp_extract_all({low}, {_q(T.VERSION)}), lambda m: 'v' || array_to_string(regexp_extract_all(m, '\\d+'), '.'))")
    for p, by in ((T.MODEL, "-"), (T.BUILD, "")):
        parts.append(f"list_transform(regexp_extract_all({low}, {_q(p)}), lambda m: regexp_extract(m, {_q(p)}, 1) || '{by}' || regexp_extract(m, {_q(p)}, 2))")
    for p, name in T.DEVICES:
        plain, _, ahead = p.partition("(?!")
        test = f"regexp_matches({c}, {_q('(?i)' + plain)})"
        if ahead:
            test += f" AND NOT regexp_matches({c}, {_q('(?i)' + plain.removesuffix(chr(92) + 'b') + ahead.rstrip(')'))})"
        parts.append(f"CASE WHEN {test} THEN ['{name}'] ELSE []::VARCHAR[] END")
    return f"list_distinct({' || '.join(parts)})"


def _words(c: str) -> str:
    return f"list_transform(list_filter(regexp_extract_all({c}, {_q(T.TOKEN)}), lambda x: length(x) > 1), lambda x: lower(x))"


def _with_tokens(source: str, keep: str, c: str) -> str:
    """A query with the columns kept, words w, aliases a and tokens t."""
    return f"SELECT *, w || list_filter(a, lambda x: NOT list_contains(w, x)) AS t FROM (SELECT {keep}, {_words(c)} AS w, {_aliases(c)} AS a FROM {source})"


def _decorated() -> str:
    cases = " ".join(f"WHEN {i} THEN {_q(s)}" for i, s in enumerate(DECORATIONS))
    return f"(SELECT doc_id, coalesce(source, '') AS title, coalesce(source, 'unknown') AS topic_id, CAST(doc_id AS VARCHAR) AS key, coalesce(text, '') || CASE doc_id % 7 {cases} ELSE '' END AS text FROM documents)"


def build(asked: list[tuple[str, str]], rules) -> dict[str, str]:
    out: dict[str, str] = {}
    exact = "regexp_matches(x, '[0-9._/-]')"
    docs = "(SELECT doc_id, coalesce(text, '') AS text FROM documents)"
    out["token_counts"] = f"WITH d AS ({_with_tokens(docs, 'doc_id', 'text')}) SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(len(list_distinct(list_filter(t, lambda x: {exact}))) AS BIGINT) AS n_exact, CAST(len(a) AS BIGINT) AS n_aliases FROM d"
    out["technical_aliases"] = f"SELECT key AS post_id, array_to_string(list_sort({_aliases('text')}), ',') AS aliases FROM {_decorated()}"

    base = f"""d AS ({_with_tokens("(SELECT *, trim(concat_ws(' ', title, text)) AS s FROM " + _decorated() + ")", "doc_id, key, title, text", "s")}),
postings AS (SELECT key, doc_id, term, count(*) AS tf FROM (SELECT key, doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
terms AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM postings GROUP BY term),
corpus AS (SELECT count(*) AS n, avg(greatest(1, len(t))) AS avg_len FROM d)"""
    out["term_stats"] = f"WITH {base} SELECT term, df, cf FROM terms"
    is_exact = "regexp_matches(term, '[0-9._/-]')"
    out["exact_terms"] = f"WITH {base} SELECT term, count(*) AS df, min(key) AS first_key FROM postings WHERE {is_exact} GROUP BY term"
    out["corpus_stats"] = f"WITH {base} SELECT n AS doc_count, round(avg_len, 6) AS avg_len, (SELECT count(*) FROM terms) AS term_count, (SELECT count(*) FROM postings WHERE {is_exact}) AS exact_postings FROM corpus"

    values = ", ".join(f"({_q(i)}, {_q(q)})" for i, q in asked)
    asked_sql = f"""q0(query_id, query) AS (VALUES {values}),
q1 AS (SELECT query_id, query, {_words('query')} AS w, {_aliases('query').removeprefix('list_distinct(').removesuffix(')')} AS r FROM q0),
q AS (SELECT query_id, query, w || list_filter(list_filter(r, lambda x, i: list_position(r, x) = i), lambda x: NOT list_contains(w, x)) AS t, list_distinct(r) AS r FROM q1),
qt AS (SELECT query_id, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS pos FROM q),
qe AS (SELECT query_id, term, rank() OVER (PARTITION BY query_id ORDER BY min(pos)) - 1 AS pos FROM qt WHERE {is_exact} GROUP BY query_id, term),
grams AS (SELECT query_id, n, i, array_to_string(t[i : i + n - 1], ' ') AS phrase FROM q, range(2, 6) AS a(n), range(1, 60) AS b(i) WHERE i + n - 1 <= len(t)),
qp AS (SELECT query_id, phrase, row_number() OVER (PARTITION BY query_id ORDER BY min(n * 1000 + i)) - 1 AS pos FROM grams WHERE regexp_matches(phrase, '[0-9]') GROUP BY query_id, phrase)"""
    joined = lambda table, col: f"(SELECT coalesce(string_agg(DISTINCT {col}, '|' ORDER BY {col}), '') FROM {table} x WHERE x.query_id = q.query_id)"
    out["query_terms"] = f"WITH {asked_sql} SELECT query_id, 'query-' || substr(sha256(trim(query)), 1, 16) AS packet_id, {joined('qt', 'term')} AS terms, {joined('qe', 'term')} AS exact_terms, {joined('qp', 'phrase')} AS phrases FROM q"
    specific = "sp AS (SELECT DISTINCT query_id, qt.term, regexp_matches(qt.term, '[._/-]') AS structured FROM qt LEFT JOIN terms USING (term), corpus WHERE NOT regexp_matches(qt.term, '^[0-9]+$') AND (coalesce(df BETWEEN 1 AND greatest(3, floor(n * 0.08)), false) OR regexp_matches(qt.term, '[._/-]')))"
    out["specific_terms"] = f"WITH {base}, {asked_sql}, {specific} SELECT query_id, term, structured FROM sp"
    scored = f"""{specific},
hits AS (
 SELECT query_id, key, p.doc_id, ln(1 + (n - df + 0.5) / (df + 0.5)) * (tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * greatest(1, len(d.t)) / avg_len))) AS bm25, 0.0::DOUBLE AS exact, 0.0::DOUBLE AS phrase, qt.term AS mt, NULL AS me, NULL AS mp, (0, pos, p.doc_id) AS touch
 FROM qt JOIN terms USING (term) JOIN postings p USING (term) JOIN d USING (key), corpus
 UNION ALL SELECT query_id, key, p.doc_id, 0, 1.75, 0, NULL, p.term, NULL, (1, pos, p.doc_id) FROM qe JOIN postings p USING (term)
 UNION ALL SELECT query_id, key, doc_id, 0, 0, 2.5, NULL, NULL, phrase, (2, pos, doc_id) FROM qp JOIN d ON contains(array_to_string(d.t, ' '), phrase)),
summed AS (SELECT query_id, key, sum(bm25) AS bm25, sum(exact) AS exact, sum(phrase) AS phrase, list_filter(list_distinct(list(mt)), lambda x: x IS NOT NULL) AS mt, list_filter(list_distinct(list(me)), lambda x: x IS NOT NULL) AS me, count(DISTINCT mp) AS mp, list_filter(list_distinct(list(mp)), lambda x: x IS NOT NULL) AS mpl, min(touch) AS touch FROM hits GROUP BY query_id, key),
sets AS (SELECT query_id, list(term) AS s, list(term) FILTER (structured) AS st FROM sp GROUP BY query_id),
full_ AS (SELECT summed.*, round(bm25 + exact + phrase, 9) AS total, coalesce(list_intersect(me, st), []) AS ms, coalesce(list_intersect(list_distinct(mt || me), s), []) AS mx FROM summed LEFT JOIN sets USING (query_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY len(ms) DESC, total DESC, len(mx) DESC, len(me) DESC, mp DESC, touch) AS rank FROM full_)"""
    snippet = """CASE WHEN len(ps) = 0 THEN substr(text, 1, 500) ELSE (CASE WHEN c - 190 > 0 THEN '...' ELSE '' END) || trim(substr(text, greatest(0, c - 190) + 1, least(length(text), c + 190) - greatest(0, c - 190)), ' ') || (CASE WHEN c + 190 < length(text) THEN '...' ELSE '' END) END"""
    out["keyword_search"] = f"""WITH {base}, {asked_sql}, {scored},
top AS (SELECT ranked.*, d.text, list_filter(list_transform(me || mt, lambda x: position(lower(x) IN lower(d.text))), lambda p: p > 0) AS ps FROM ranked JOIN d USING (key) WHERE rank <= 10),
placed AS (SELECT *, list_min(ps) - 1 AS c FROM top)
SELECT query_id, CAST(rank AS INTEGER) AS rank, key, round(total, 6) AS score, round(bm25, 6) AS bm25, round(exact, 6) AS exact, round(phrase, 6) AS phrase, array_to_string(list_sort(mx), '|') AS specific, {snippet} AS snippet FROM placed"""

    out["suite_checks"] = f"""WITH {base}, {asked_sql}, {scored},
top AS (SELECT * FROM ranked WHERE rank <= 10),
cases(c) AS (VALUES ('q1'), ('q2'), ('q4'), ('q6'), ('q9')),
v AS (SELECT c, coalesce((SELECT list_distinct(flatten(list(mt))) FROM top WHERE query_id = c), []) AS terms, coalesce((SELECT list_distinct(flatten(list(me))) FROM top WHERE query_id = c), []) AS exact, (SELECT max(round(total, 6)) FROM top WHERE query_id = c) AS high, EXISTS (SELECT 1 FROM top WHERE query_id = c AND rank = 1) AS first FROM cases),
r AS (SELECT c, unnest(range(7)) AS n, unnest(['all', 'contains', 'prefix', 'minimum', 'at_most', 'absent', 'equal']) AS op, unnest([list_has_all(terms, ['boot.img', 'bootloop']), len(list_filter(exact, lambda x: contains(x, 'img'))) > 0, len(list_filter(terms, lambda x: starts_with(x, 'flash') OR starts_with(x, 'lic'))) > 0, coalesce(high >= 20, false), first, NOT list_contains(exact, 'recovery.img'), true]) AS ok FROM v)
SELECT c AS case_id, c || '-' || n AS check_id, op, ok FROM r"""

    feats = lambda src, key, t: f"""(SELECT {key} AS key, 'tok:' || x AS f, 1.0 AS w FROM (SELECT {key}, unnest({t}) AS x FROM {src})
 UNION ALL SELECT {key}, 'tri:' || substr(n, i, 3), 0.3 FROM (SELECT {key}, n, unnest(range(1, length(n) - 1)) AS i FROM (SELECT {key}, translate(unnest({t}), '_-.', '') AS n FROM {src}) WHERE length(n) >= 5)
 UNION ALL SELECT {key}, 'quad:' || substr(n, i, 4), 0.45 FROM (SELECT {key}, n, unnest(range(1, length(n) - 2)) AS i FROM (SELECT {key}, translate(unnest({t}), '_-.', '') AS n FROM {src}) WHERE length(n) >= 7))"""  # noqa: E731
    hashed = lambda name, src, key, t: f"""{name}_f AS (SELECT key, f, w * count(*) AS w, ('0x' || substr(md5(f), 1, 8))::BIGINT AS h FROM {feats(src, key, t)} GROUP BY key, f, w),
{name}_b AS (SELECT key, CAST(h % 256 AS INTEGER) AS bucket, sum(w * CASE WHEN h % 2 = 1 THEN 1.0 ELSE -1.0 END)::DOUBLE AS w FROM {name}_f GROUP BY key, h % 256),
{name} AS (SELECT * FROM (SELECT key, bucket, round(w / sqrt(sum(w * w) OVER (PARTITION BY key)), 6) AS w FROM {name}_b) WHERE w <> 0)"""  # noqa: E731
    stored = hashed("v", "d", "key", "t")
    asked_v = hashed("qv", "q", "query_id", "t")
    out["hashed_vectors"] = f"WITH {base}, {stored} SELECT bucket, count(*) AS docs, round(sum(abs(w)), 6) AS weight, max(w) AS top FROM v GROUP BY bucket"
    dots = f"""{stored}, {asked_v},
dots AS (SELECT qv.key AS query_id, v.key, round(sum(qv.w * v.w), 9) AS dot FROM v JOIN qv USING (bucket) GROUP BY qv.key, v.key HAVING round(sum(qv.w * v.w), 9) > 0),
vr AS (SELECT query_id, dots.key, round(dot, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY dot DESC, doc_id) AS rank FROM dots JOIN d USING (key))"""
    out["vector_search"] = f"WITH {base}, {asked_sql}, {dots} SELECT query_id, key, score, CAST(rank AS INTEGER) AS rank FROM vr WHERE rank <= 10"
    out["hybrid_search"] = f"""WITH {base}, {asked_sql}, {scored}, {dots},
b AS (SELECT coalesce(k.query_id, x.query_id) AS query_id, coalesce(k.key, x.key) AS key, coalesce(round(k.total, 6), 0) AS kr, coalesce(x.score, 0) AS vs, k.rank AS keyword_rank, x.rank AS vector_rank FROM (SELECT * FROM ranked WHERE rank <= 80) k FULL JOIN (SELECT * FROM vr WHERE rank <= 80) x ON k.query_id = x.query_id AND k.key = x.key),
s AS (SELECT *, round(0.65 * coalesce(kr / nullif(max(kr) OVER w, 0), 0) + 0.35 * coalesce(vs / nullif(max(vs) OVER w, 0), 0), 6) AS score FROM b WINDOW w AS (PARTITION BY query_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, coalesce(keyword_rank, 999999), coalesce(vector_rank, 999999), kr DESC, vs DESC, key) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, key, score, CAST(keyword_rank AS INTEGER) AS keyword_rank, CAST(vector_rank AS INTEGER) AS vector_rank FROM r WHERE rank <= 10"""

    found, entity_base, relations = _entity_sql(rules)
    out |= found
    out |= claim_oracles.build(entity_base, relations, f"{base}, {asked_sql}, {scored}", dots, rules)
    out |= _page_sql()
    return out


def _entity_sql(R) -> tuple[dict[str, str], str, str]:
    rows = []
    for n, (kind, p, flags, form) in enumerate(R.PATTERNS):
        shape = {"keep": "trim(regexp_replace(m, '\\s+', ' ', 'g'))", "upper": "upper(m)"}[form]
        rows.append(f"SELECT key, {n} AS rule, '{kind}' AS kind, {shape} AS value, i FROM (SELECT key, unnest(regexp_extract_all(text, {_q('(?i)' * bool(flags) + p)})) AS m, generate_subscripts(regexp_extract_all(text, {_q('(?i)' * bool(flags) + p)}), 1) AS i FROM d)")
    for n, (kind, w, name) in enumerate([*R.WORDS, *R.ISSUES]):
        rows.append(f"SELECT key, {100 + n}, '{kind}', {_q(name)}, 0 FROM d WHERE regexp_matches(low, {_q(chr(92) + 'b' + w + chr(92) + 'b')})")
    for n, (p, _) in enumerate(R.FILES):
        rows.append(f"SELECT key, {200 + n}, 'file', lower(m), i FROM (SELECT key, unnest(regexp_extract_all(text, {_q('(?i)' + p)})) AS m, generate_subscripts(regexp_extract_all(text, {_q('(?i)' + p)}), 1) AS i FROM d)")
    files = "(SELECT DISTINCT e.key, value AS f, regexp_replace(value, '([.-])', '\\\\\\1', 'g') AS p, low FROM e0 e JOIN d USING (key) WHERE kind = 'file')"
    seen = lambda *parts: "regexp_matches(low, " + " || ".join(x if x == "p" else _q(x) for x in parts) + ")"
    tool, patched = rf"\b{R.ROOT_TOOL}\b", rf"\b{R.PATCHED}\b"
    flashed, by_tool, rec = rf"\b{R.FLASHED}\b", rf"\b{R.RECOVERY_TOOL}\b", r"recovery\.img"
    rooted = f"f IN ('boot.img', 'init_boot.img') AND ({seen(patched, '[^.?!]{0,120}', 'p')} OR {seen('p', '[^.?!]{0,120}', patched)} OR (({seen('p', '[^.?!]{0,120}', tool)} OR {seen(tool, '[^.?!]{0,120}', 'p')}) AND NOT {seen(R.ROOT_FAILS)}))"
    recovers = f"f = 'recovery.img' AND ({' OR '.join(seen(x) for x in (flashed + '[^.?!]{0,120}' + rec, rec + '[^.?!]{0,160}' + flashed, rec + '[^.?!]{0,160}' + by_tool, rec + '.{0,240}' + by_tool + '.{0,120}' + flashed, rec + '.{0,240}' + flashed + '.{0,120}' + by_tool))})"
    more = [
        f"SELECT key, 300, 'fix', 'restore ' || f, 0 FROM files WHERE {seen(R.RESTORE, 'p')}",
        f"SELECT key, 301, 'fix', 'flash ' || f, 0 FROM files WHERE {seen(R.FLASH, 'p')}",
        f"SELECT key, 302, 'root_action', 'patch ' || f, 0 FROM files WHERE {rooted}",
        f"SELECT key, 303, 'recovery_action', 'flash ' || f, 0 FROM files WHERE {recovers}",
        f"SELECT files.key, 304, 'warning', 'do not install ' || f || ' from ' || c.value, 0 FROM files JOIN (SELECT key, value FROM e0 WHERE kind = 'codename') c USING (key) WHERE (contains(low, 'warning') OR contains(low, 'важно') OR contains(low, 'не ставить')) AND regexp_matches(low, {_q(R.WARNS)} || p || '.{{0,80}}(?:от|from)\\s+' || c.value)".replace("{{", "{").replace("}}", "}"),
    ]
    base = f"""d AS (SELECT *, lower(text) AS low FROM {_decorated()}),
e0 AS ({' UNION ALL '.join(rows)}), files AS {files},
e1 AS (SELECT * FROM e0 UNION ALL {' UNION ALL '.join(more)}),
e AS (SELECT key, kind, first(value ORDER BY rule, i) AS value FROM e1 WHERE value <> '' GROUP BY key, kind, lower(value))"""
    pairs = []
    for kind, source, targets, need, confidence in R.RELATIONS:
        ok = " AND contains(lower(a.value), lower(b.value))" if need == "in" else f" AND b.value IN ({', '.join(map(_q, need))})" if need else ""
        pairs.append(f"SELECT '{kind}' AS kind, 'entity:' || a.kind || ':' || a.value AS from_node, 'entity:' || b.kind || ':' || b.value AS to_node, a.key AS post_id, {confidence}::DOUBLE AS confidence FROM e a JOIN e b USING (key) WHERE a.kind = '{source}' AND b.kind IN ({', '.join(map(_q, targets))}){ok}")
    found = {
        "entity_mentions": f"WITH {base} SELECT kind, value, count(*) AS posts, min(key) AS first_post FROM e GROUP BY kind, value",
        "relation_edges": f"WITH {base} SELECT DISTINCT from_node || '->' || to_node || ':' || kind || ':post:' || post_id AS edge_id, * FROM ({' UNION ALL '.join(pairs)})",
        "graph_nodes": f"""WITH {base} SELECT 'topic:' || topic_id AS node_id, 'topic' AS kind, max(title) AS label, 0::BIGINT AS refs, 1.0::DOUBLE AS confidence FROM d GROUP BY topic_id
UNION ALL SELECT 'post:' || key, 'post', 'Post ' || key, 1, 1.0 FROM d UNION ALL SELECT 'entity:' || kind || ':' || value, kind, value, count(*), 0.6 FROM e GROUP BY kind, value""",
        "graph_edges": f"""WITH {base} SELECT 'topic_contains_post' AS kind, 1.0::DOUBLE AS confidence, count(*) AS edges, count(DISTINCT topic_id || '>' || key) AS distinct_edges FROM d
UNION ALL SELECT 'post_mentions_entity', 0.6, count(*), count(DISTINCT key || '>' || kind || '>' || value) FROM e""",
    }
    return found, base, ' UNION ALL '.join(pairs)


def _run_sql(seeds: str, plan: str) -> dict[str, str]:
    """SQL of the audits of runs; plan holds the seeds too."""
    base = f"""{plan}, ev AS (SELECT *, user_id % 50 AS n, 'c' || CAST(user_id % 50 AS VARCHAR) AS chain FROM events),
rc AS (SELECT chain, ['crawl', 'normalize', 'index', 'vector', 'graph'][CASE WHEN n = 49 THEN event_id % 4 + 2 ELSE event_id % 5 + 1 END] AS stage, event_id AS receipt_id, CASE WHEN n % 2 = 0 THEN 'run' ELSE 'run' || CAST(event_id % 2 AS VARCHAR) END AS run_id, CASE WHEN n % 10 = 3 THEN 'p2' ELSE 'p1' END AS profile_id, ts AS t_at, event_id % 7 = 0 AS failed, event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0 AS kept, event_id % 11 = 0 AS touched, event_id % 30 AS items FROM ev),
nw AS (SELECT * FROM rc QUALIFY row_number() OVER (PARTITION BY chain, stage ORDER BY t_at DESC, receipt_id DESC) = 1),
w AS (SELECT chain, count(*) = 5 AS whole, count(*) FILTER (stage <> 'crawl') = 4 AS derived, bool_or(stage = 'crawl') AS crawled, count(DISTINCT run_id) AS runs, count(*) FILTER (stage <> 'normalize' AND profile_id = 'p1') AS own, bool_or(kept) FILTER (stage = 'crawl') AS kept, bool_or(failed) FILTER (stage = 'crawl') AS failed, bool_or(touched) FILTER (stage <> 'crawl') AS touched,
 max(t_at) FILTER (stage = 'crawl') AS c, max(t_at) FILTER (stage = 'normalize') AS n, max(t_at) FILTER (stage = 'index') AS i, max(t_at) FILTER (stage = 'vector') AS v, max(t_at) FILTER (stage = 'graph') AS g,
 max(items) FILTER (stage = 'normalize') AS n_items, max(items) FILTER (stage = 'index') AS i_items, max(items) FILTER (stage = 'vector') AS v_items, max(items) FILTER (stage = 'graph') AS g_items FROM nw GROUP BY chain),
pg AS (SELECT DISTINCT chain, 's' || CAST(CASE WHEN n = 7 THEN 99 ELSE event_id % 8 END AS VARCHAR) AS seed_id, CAST(event_id // 8 % 5 * 20 AS VARCHAR) AS page_start FROM ev),
got AS (SELECT chain, count(*) AS fetched, count(*) FILTER (EXISTS (SELECT 1 FROM plan WHERE plan.seed_id = pg.seed_id AND plan.page_start = pg.page_start)) AS hit FROM pg GROUP BY chain),
nd(need_id, focus, cases, required, for_ready, for_deep) AS (VALUES ('n1', ['f0'], ['a'], true, true, true), ('n2', ['f9'], ['a'], true, false, false), ('n3', ['f0', 'f1'], [], false, true, true), ('n4', ['f1'], ['a', 'z'], true, false, false), ('n5', ['f3'], ['b'], true, true, true)),
ns AS (SELECT chain, need_id, for_ready, for_deep, CASE WHEN NOT EXISTS (SELECT 1 FROM seeds s WHERE list_contains(nd.focus, s.focus)) THEN 'missing_seed_focus' WHEN NOT EXISTS (SELECT 1 FROM pg JOIN seeds s USING (seed_id) WHERE pg.chain = w.chain AND list_contains(nd.focus, s.focus)) THEN 'unmaterialized' WHEN required AND (len(cases) = 0 OR len(list_filter(cases, lambda z: z NOT IN ('a', 'b'))) > 0) THEN 'missing_eval_route' ELSE 'covered' END AS status FROM w, nd),
dc AS (SELECT chain, bool_and(status = 'covered') FILTER (for_deep) AS deep FROM ns GROUP BY chain),
j AS (SELECT w.*, coalesce(fetched, 0) AS fetched, coalesce(hit, 0) AS hit, (SELECT count(*) FROM (SELECT DISTINCT seed_id, page_start FROM plan)) AS expected, deep FROM w LEFT JOIN got USING (chain) JOIN dc USING (chain)),
ck AS (SELECT chain, crawled, unnest(['profile_exists', 'seed_file_exists', 'seed_urls_allowed_public_topics', 'receipt_chain_present', 'receipts_share_run', 'receipt_profile_matches', 'crawl_policy_preserved', 'derived_stages_network_free', 'all_expected_seed_pages_fetched', 'normalized_pages_cover_fetched_pages', 'index_has_docs', 'vector_has_docs', 'graph_has_edges', 'quality_gate_suites_present', 'information_need_matrix_present', 'deep_information_needs_covered']) AS check,
 unnest([true, true, true, whole, whole AND runs = 1, own = 4, coalesce(kept, false), derived AND NOT touched, expected > 0 AND hit = expected, fetched > 0 AND coalesce(n_items, 0) >= fetched, coalesce(i_items > 0, false), coalesce(v_items > 0, false), coalesce(g_items > 0, false), true, true, deep]) AS ok FROM j),
st AS (SELECT chain, CASE WHEN NOT bool_or(crawled) THEN 'no_run' WHEN bool_and(ok) THEN 'coverage_ready' ELSE 'partial' END AS status FROM ck GROUP BY chain)"""
    return {
        "need_states": f"WITH {base} SELECT * FROM ns",
        "coverage_checks": f'WITH {base} SELECT chain, crawled, "check", ok FROM ck',
        "refresh_states": f"""WITH {base}, f AS (SELECT chain, crawled, [whole, c IS NOT NULL, coalesce(round(greatest(0, (SELECT epoch_us(max(t_at)) FROM rc) - epoch_us(c)) / 3600e6, 2) <= 168, false), coalesce(NOT failed, false), coalesce(kept, false), derived AND NOT touched, derived, coalesce(n >= c AND i >= n AND v >= n AND g >= n, false), st.status = 'coverage_ready'] AS oks FROM w JOIN st USING (chain))
SELECT chain, len(list_filter(oks, lambda x: NOT x)) AS failed, CASE WHEN NOT crawled THEN 'missing_run' WHEN len(list_filter(oks, lambda x: NOT x)) = 0 THEN 'fresh' ELSE 'needs_refresh' END AS status FROM f""",
        "readiness": f"""WITH {base}, x AS (SELECT j.chain, ['achieved', CASE WHEN st.status = 'coverage_ready' THEN 'achieved' ELSE 'partial' END, CASE WHEN deep THEN 'achieved' ELSE 'partial' END, CASE WHEN whole AND runs = 1 AND kept AND NOT touched AND i_items > 0 AND v_items > 0 AND g_items > 0 THEN 'achieved' ELSE 'partial' END] AS g FROM j JOIN st USING (chain)),
y AS (SELECT chain, len(list_filter(g, lambda z: z = 'achieved')) AS achieved, len(list_filter(g, lambda z: z = 'partial')) AS partial, 0::BIGINT AS missing FROM x)
SELECT *, CASE WHEN partial = 0 THEN 'ready' ELSE 'not_ready' END AS status FROM y""",
    }


def _page_sql() -> dict[str, str]:
    urls = """u AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'http://' ELSE 'https://' END || CASE WHEN page_id % 5 = 0 THEN 'www.forum.example.org' ELSE 'forum.example.org' END || '/index.php?showtopic=' || CAST(page_id % 50 AS VARCHAR) || CASE page_id % 6 WHEN 0 THEN '&act=search' WHEN 1 THEN '&st=' WHEN 2 THEN '#entry5' ELSE '&st=' || CAST(page_id % 3 * 20 AS VARCHAR) END FROM pages),
p AS (SELECT *, regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)', 1) AS scheme, regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)', 2) AS host, regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)', 3) AS path, regexp_extract(url, '\\?([^#]*)', 1) AS query FROM u),
k AS (SELECT *, regexp_extract(query, '(^|&)showtopic=([^&]*)', 2) AS st0, regexp_extract(query, '(^|&)st=([^&]*)', 2) AS st1 FROM p),
c AS (SELECT *, scheme IN ('http', 'https') AND host = 'forum.example.org' AND path = '/index.php' AND contains(query, 'showtopic=') AND NOT regexp_matches(path || '?' || query, 'act=(search|Search|findpost|attach|login|Login|auth|usercp|post|Post|report|warn)|/dl|/lofiversion/') AS allowed, CASE WHEN st0 = '' THEN 'unknown' ELSE st0 END AS topic_id, CASE WHEN st1 = '' THEN '0' ELSE st1 END AS page_start FROM k)"""
    canonical = "scheme || '://' || host || path || '?showtopic=' || st0 || '&st=' || page_start"
    plain = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({0}, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g'))"
    first = lambda tag: "nullif(" + plain.format(f"regexp_extract(html, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}>', 1)") + ", '')"
    anchor = "(?is)<a\\s[^>]*?href=\"[^\"]*\"[^>]*>.*?</a>"
    links = "SELECT 'https://forum.example.org/index.php?showtopic=' || CAST(page_id % 9 AS VARCHAR) AS source_url, 'label ' || CAST(page_id % 4 AS VARCHAR) AS source_label, page_id AS ord, 'topic ' || CAST(page_id % 50 AS VARCHAR) AS anchor_text, topic_id, page_start, " + canonical + " AS url FROM c WHERE allowed AND contains(url, 'showtopic')"
    seeds = "seeds AS (SELECT i AS seed_ord, 's' || i AS seed_id, CAST(3 * i AS VARCHAR) AS topic_id, CAST(20 * (i % 3) AS VARCHAR) AS page_start, 'f' || (i % 4) AS focus, i % 3 + 1 AS max_pages FROM range(10) t(i))"
    found = f"""{urls}, {seeds}, l AS (SELECT * FROM ({links}) x WHERE NOT EXISTS (SELECT 1 FROM seeds s WHERE s.topic_id = x.topic_id AND s.page_start = x.page_start)),
g AS (SELECT url, topic_id, page_start, count(*) AS source_count, bool_or(regexp_matches(source_label || ' ' || source_url, '(?i)topic 7|label 3')) AS source_hit, topic_id IN (SELECT topic_id FROM seeds) AS seeded FROM l GROUP BY ALL),
an AS (SELECT url, string_agg(anchor_text, '|' ORDER BY n) AS anchor_texts FROM (SELECT url, anchor_text, row_number() OVER (PARTITION BY url ORDER BY min(ord), anchor_text) AS n FROM l GROUP BY url, anchor_text) WHERE n <= 8 GROUP BY url),
cand AS (SELECT url, topic_id, page_start, CASE WHEN seeded THEN 'seed_topic_new_window' ELSE 'unseeded_topic' END AS candidate_kind, source_count, anchor_texts, CASE WHEN seeded OR source_count >= 8 OR regexp_matches(lower(url || ' ' || anchor_texts || ' ' || topic_id), 'topic 7|label 3') THEN 'high' WHEN source_hit OR source_count >= 2 THEN 'medium' ELSE 'low' END AS review_priority FROM g JOIN an USING (url))"""
    plan = f"{seeds}, plan AS (SELECT seed_id, CAST(i AS INTEGER) AS page_index, CAST(CAST(page_start AS INTEGER) + i * 20 AS VARCHAR) AS page_start, 'https://forum.example.org/index.php?showtopic=' || topic_id || '&st=' || CAST(CAST(page_start AS INTEGER) + i * 20 AS VARCHAR) AS url FROM seeds, range(3) r(i) WHERE i < max_pages AND seed_ord < 8)"
    fetched = "fetched AS (SELECT DISTINCT 's' || CAST(user_id % 9 AS VARCHAR) AS seed_id, CAST(event_id % 3 * 20 AS VARCHAR) AS page_start FROM events)"
    needs = "needs(need_id, focus, cases) AS (VALUES ('n1', ['f0'], ['a']), ('n2', ['f9'], ['a']), ('n3', ['f0', 'f1'], []), ('n4', ['f1'], ['a', 'z']), ('n5', ['f3'], ['b']))"
    receipts = "r AS (SELECT 'run' || CAST(user_id AS VARCHAR) AS run_id, ['crawl', 'normalize', 'index', 'vector', 'graph'][event_id % 5 + 1] AS stage, ts AS t_at, event_id FROM events)"
    srcs = "s AS (SELECT 'id' || i AS source_id, 'https://forum.example.org/index.php?showtopic=' || i || '&st=' || CASE WHEN i % 5 = 0 THEN 'x' ELSE CAST(i * 20 - 20 AS VARCHAR) END AS source_ref, CASE WHEN i % 3 = 0 THEN 'profile' ELSE 'topic' END AS kind, CASE WHEN i % 4 = 0 THEN 'login' ELSE 'public' END AS access, CASE WHEN i % 6 = 0 THEN 'images' ELSE 'none' END AS media, i, i % 7 <> 0 AS enabled FROM range(30) t(i))"
    return {
        "url_policy": f"WITH {urls} SELECT page_id, url, allowed, CASE WHEN allowed THEN {canonical} END AS canonical, topic_id, page_start FROM c",
        "page_titles": f"SELECT page_id, coalesce({first('h1')}, {first('title')}, 'Untitled topic') AS title FROM pages",
        "page_links": f"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '{anchor}')) AS a, generate_subscripts(regexp_extract_all(html, '{anchor}'), 1) - 1 AS ord FROM pages),
b AS (SELECT page_id, CAST(ord AS INTEGER) AS ord, regexp_extract(a, '(?is)href="([^"]*)"', 1) AS url, {plain.format("regexp_extract(a, '(?is)<a\\s[^>]*>(.*?)</a>', 1)")} AS anchor_text FROM a)
SELECT page_id, min(ord) AS ord, url, arg_min(anchor_text, ord) AS anchor_text FROM b WHERE url <> '' GROUP BY page_id, url""",
        "discovery_candidates": f"WITH {found} SELECT * FROM cand",
        "seed_review": f"WITH {found} SELECT url, candidate_kind, source_count, CASE WHEN url = 'https://forum.example.org/index.php?showtopic=7&st=20' THEN 'accept' WHEN candidate_kind = 'seed_topic_new_window' AND source_count >= 3 THEN 'expand' WHEN topic_id = '11' THEN 'reject' WHEN candidate_kind = 'unseeded_topic' AND source_count >= 2 THEN 'watch' ELSE 'unreviewed' END AS decision FROM cand",
        "crawl_plan": f"WITH {plan} SELECT * FROM plan",
        "coverage": f"WITH {plan}, {fetched} SELECT plan.seed_id, count(*) AS planned, count(f.seed_id) AS fetched_pages, round(count(f.seed_id) / count(*), 4) AS ratio FROM plan LEFT JOIN fetched f ON f.seed_id = plan.seed_id AND f.page_start = plan.page_start GROUP BY plan.seed_id",
        "missing_pages": f"WITH {plan}, {fetched} SELECT * FROM plan WHERE NOT EXISTS (SELECT 1 FROM fetched f WHERE f.seed_id = plan.seed_id AND f.page_start = plan.page_start)",
        "need_coverage": f"WITH {seeds}, {fetched}, {needs} SELECT need_id, CASE WHEN NOT EXISTS (SELECT 1 FROM seeds s WHERE list_contains(n.focus, s.focus)) THEN 'missing_seed_focus' WHEN NOT EXISTS (SELECT 1 FROM seeds s JOIN fetched USING (seed_id) WHERE list_contains(n.focus, s.focus)) THEN 'unmaterialized' WHEN len(cases) = 0 THEN 'missing_eval_route' ELSE 'covered' END AS status FROM needs n",
        "route_ratio": f"WITH {needs}, x AS (SELECT len(cases) > 0 AND len(list_filter(cases, lambda z: z NOT IN ('a', 'b'))) = 0 AS ok FROM needs) SELECT count(*) FILTER (ok) AS complete, count(*) AS total, round(count(*) FILTER (ok) / count(*), 4) AS ratio FROM x",
        "refresh_audit": f"""WITH {receipts}, w AS (SELECT run_id, max(t_at) FILTER (stage = 'crawl') AS c, max(t_at) FILTER (stage = 'normalize') AS n, max(t_at) FILTER (stage = 'index') AS i, max(t_at) FILTER (stage = 'vector') AS v, max(t_at) FILTER (stage = 'graph') AS g FROM r GROUP BY run_id),
x AS (SELECT run_id, c, CASE WHEN c IS NOT NULL THEN round(greatest(0, epoch((SELECT date_trunc('second', max(t_at)) FROM r)) + (SELECT (epoch_us(max(t_at)) % 1000000) / 1e6 FROM r) - epoch_us(c) / 1e6) / 3600, 2) END AS age_hours, coalesce(n >= c AND i >= n AND v >= n AND g >= n, false) AS derived_in_order FROM w)
SELECT run_id, age_hours, derived_in_order, CASE WHEN c IS NULL THEN 'missing_run' WHEN age_hours <= 168 AND derived_in_order THEN 'fresh' ELSE 'needs_refresh' END AS status FROM x""",
        "review_state": f"""WITH {found}, dec(url, decision) AS (VALUES ('https://forum.example.org/index.php?showtopic=7&st=20', 'accept'), ('https://forum.example.org/index.php?showtopic=999&st=0', 'reject')),
rv AS (SELECT cand.*, coalesce(dec.decision, CASE WHEN candidate_kind = 'seed_topic_new_window' AND source_count >= 3 THEN 'accept' WHEN topic_id = '11' THEN 'reject' ELSE 'unreviewed' END) AS d, EXISTS (SELECT 1 FROM seeds s WHERE cand.url = 'https://forum.example.org/index.php?showtopic=' || s.topic_id || '&st=' || s.page_start) AS is_seed FROM cand LEFT JOIN dec USING (url)),
x AS (SELECT count(*) AS candidate_count, count(*) FILTER (d = 'unreviewed') AS unreviewed_count, count(*) FILTER (d = 'accept' AND is_seed) AS accepted_seeded_count, count(*) FILTER (d = 'accept' AND NOT is_seed) AS accepted_missing_from_seed_count, count(*) FILTER (d = 'reject') AS rejected_count, (SELECT count(*) FROM dec WHERE NOT EXISTS (SELECT 1 FROM cand WHERE cand.url = dec.url)) AS stale_decision_count FROM rv)
SELECT *, CASE WHEN unreviewed_count > 0 THEN 'needs_review' WHEN accepted_missing_from_seed_count > 0 THEN 'reviewed_pending_seed_update' ELSE 'reviewed' END AS status FROM x""",
        "review_order": f"WITH {found}, o AS (SELECT row_number() OVER (ORDER BY CASE review_priority WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, candidate_kind = 'seed_topic_new_window', source_count DESC, topic_id, page_start, url) AS place, * FROM cand) SELECT CAST(place AS INTEGER) AS place, url, review_priority, candidate_kind, source_count FROM o WHERE place <= 40",
        "link_counts": f"WITH {urls} SELECT CASE WHEN allowed THEN 'allowed' ELSE 'denied' END AS verdict, count(*) AS links, count(DISTINCT url) AS addresses FROM c GROUP BY ALL",
        "coverage_summary": f"""WITH {plan}, {fetched}, pg AS (SELECT DISTINCT seed_id, page_start FROM plan), sd AS (SELECT DISTINCT plan.seed_id, focus, EXISTS (SELECT 1 FROM fetched f WHERE f.seed_id = plan.seed_id) AS there FROM plan JOIN seeds USING (seed_id)),
x AS (SELECT (SELECT count(*) FROM pg) AS expected_pages, (SELECT count(*) FROM pg SEMI JOIN fetched USING (seed_id, page_start)) AS fetched_pages, count(*) AS expected_seeds, count(*) FILTER (there) AS fetched_seeds, count(DISTINCT focus) AS expected_focus, count(DISTINCT focus) FILTER (there) AS captured_focus FROM sd)
SELECT *, round(fetched_pages / expected_pages, 4) AS page_ratio, CASE WHEN (SELECT count(*) FROM fetched) = 0 THEN 'no_run' WHEN expected_pages = fetched_pages AND expected_focus = captured_focus THEN 'coverage_ready' ELSE 'partial' END AS status FROM x""",
        "refresh_checks": f"""WITH {receipts}, w AS (SELECT run_id, max(t_at) FILTER (stage = 'crawl') AS c, max(t_at) FILTER (stage = 'normalize') AS n, max(t_at) FILTER (stage = 'index') AS i, max(t_at) FILTER (stage = 'vector') AS v, max(t_at) FILTER (stage = 'graph') AS g, max(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) FILTER (stage = 'crawl') AS errors, bool_or(event_id % 11 = 0) FILTER (stage <> 'crawl') AS touched FROM r GROUP BY run_id),
x AS (SELECT *, n IS NOT NULL AND i IS NOT NULL AND v IS NOT NULL AND g IS NOT NULL AS derived FROM w)
SELECT run_id, unnest(['receipt_chain_present', 'crawl_age_within_limit', 'crawl_errors_zero', 'derived_stages_network_free', 'derived_timestamps_present', 'derived_not_older_than_crawl']) AS check, unnest([c IS NOT NULL AND derived, coalesce((SELECT epoch_us(max(t_at)) FROM r) - epoch_us(c) <= 168 * 3600 * 1000000::BIGINT, false), coalesce(errors = 0, false), coalesce(derived AND NOT touched, false), derived, coalesce(n >= c AND i >= n AND v >= n AND g >= n, false)]) AS ok FROM x""",
        "page_posts": """WITH d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
k AS (SELECT *, trim(regexp_replace(regexp_replace(text, '-{10,}', ' ', 'g'), '\\s+', ' ', 'g')) AS clean, trim(regexp_replace(regexp_replace(substr('>' || text, 1, 12000), '-{10,}', ' ', 'g'), '\\s+', ' ', 'g')) AS shown, doc_id % 4 AS m FROM d)
SELECT doc_id AS page_id, CASE WHEN m = 3 OR clean = '' THEN 'window' ELSE ['table', 'post_body', 'article'][m + 1] END AS layout, 0::INTEGER AS ord, CAST(doc_id AS VARCHAR) AS post_id, CASE WHEN m = 0 AND clean <> '' THEN trim(regexp_replace('by ' || source, '\\s+', ' ', 'g')) END AS author_label, CASE WHEN m = 0 AND clean <> '' THEN '01.02.21, 10:30' END AS posted_at,
 CASE WHEN m = 3 THEN substr(shown, 1, 8000) WHEN clean = '' AND m = 0 THEN '> foot' WHEN clean = '' THEN '>' WHEN m = 0 THEN substr(clean, 1, 8000) ELSE clean END AS text FROM k WHERE m <> 2 OR clean <> ''""",
        "decoded_pages": "WITH t AS (SELECT doc_id, 'Прошивка ' || CASE WHEN doc_id % 2 = 0 THEN coalesce(text, '') ELSE regexp_replace(coalesce(text, ''), '[^\\x00-\\x7F]', '?', 'g') END AS x FROM documents) SELECT doc_id, sha256(x) AS sha256, length(x) AS n_chars FROM t",
        "source_errors": """WITH g AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN ' ' ELSE c_name END AS source_ref, CASE WHEN c_custkey % 7 = 0 THEN 'blog' ELSE 'topic' END AS kind, c_custkey AS k, c_acctbal / 10000 AS trust FROM customer)
SELECT source_ref, kind, unnest(list_filter([CASE WHEN trim(source_ref) = '' THEN 'empty_source_ref' END, CASE WHEN kind = 'blog' THEN 'unsupported_kind' END, CASE WHEN k % 11 = 0 THEN 'unsupported_access' END, CASE WHEN k % 13 = 0 THEN 'unsupported_media_policy' END, CASE WHEN trust < 0 OR trust > 1 THEN 'trust_score_out_of_range' END], lambda x: x IS NOT NULL)) AS error FROM g""",
        "source_upsert": """WITH c AS (SELECT *, 'https://forum.example.org/index.php?showtopic=' || CAST(c_custkey % 40 AS VARCHAR) AS ref, CASE WHEN c_custkey % 3 = 0 THEN 'topic' ELSE 'forum' END AS kind FROM customer),
o AS (SELECT ref, kind, 'old ' || min(c_custkey) AS title FROM c WHERE c_custkey % 2 = 0 GROUP BY ref, kind),
n AS (SELECT ref, kind, max(c_custkey) AS k, arg_max(c_name, c_custkey) AS name, arg_max(c_mktsegment, c_custkey) AS segment FROM c WHERE c_custkey % 5 = 0 GROUP BY ref, kind),
b AS (SELECT coalesce(n.ref, o.ref) AS ref, coalesce(n.kind, o.kind) AS kind, o.title AS old_title, o.ref IS NOT NULL AS was, n.ref IS NOT NULL AS is_new, k, name, segment FROM o FULL JOIN n ON o.ref = n.ref AND o.kind = n.kind)
SELECT 'src-' || substr(sha256(kind || ':' || lower(ref)), 1, 16) AS source_id, ref AS source_ref, kind, 'public' AS access, coalesce(CASE WHEN is_new AND k % 2 = 0 THEN name END, old_title, ref) AS title, CASE WHEN was THEN 's' ELSE 'operator_selected_' || kind END AS scope,
 CASE WHEN is_new AND k % 3 = 0 THEN replace(lower(trim(segment)), ' ', '-') || '|two-words' WHEN was THEN 'kept' ELSE '' END AS tags, CASE WHEN is_new AND k % 4 = 0 THEN 0.75::DOUBLE WHEN was THEN 0.5 END AS trust_score, true AS enabled, 'none' AS include_media, CASE WHEN was THEN '2025-01-01' ELSE '2026-01-08T00:00:00Z' END AS created_at, CASE WHEN is_new THEN '2026-01-08T00:00:00Z' ELSE '2025-01-01' END AS updated_at, CASE WHEN is_new AND was THEN 'updated' WHEN is_new THEN 'created' ELSE 'kept' END AS change FROM b""",
        **_run_sql(seeds, plan),
        "latest_receipts": f"WITH {receipts} SELECT stage, run_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY t_at DESC, run_id DESC) AS n FROM r) WHERE n = 1",
        "dedupe_latest": "SELECT conv_id, role, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC, text) AS n FROM conversations) WHERE n = 1",
        "source_select": f"WITH {srcs} SELECT source_id, source_ref, 'src-' || substr(sha256(kind || ':' || lower(source_ref)), 1, 16) AS stable_id FROM s WHERE enabled AND kind = 'topic' AND i % 3 IN (1, 2)",
        "preflight_errors": f"""WITH {srcs} SELECT source_id, source_ref, unnest(list_filter([CASE WHEN kind <> 'topic' THEN 'unsupported_source_kind' END, CASE WHEN access <> 'public' THEN 'unsupported_access_mode' END, CASE WHEN media <> 'none' THEN 'media_download_disabled' END, CASE WHEN i % 5 = 0 OR i = 0 THEN 'invalid_topic_offset' END], lambda x: x IS NOT NULL)) AS error_code FROM s""",
    }
