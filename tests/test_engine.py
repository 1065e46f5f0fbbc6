from pyspark.sql import functions as F

from tracewell.operators import answers, claims, corpus, entities, keyword, retrieval, vectors
from tracewell.sources.pages import visible_text

POSTS = [
    ("t", "1001", "Topic", "u#1001", "01.04.21, 09:32", "2026-01-01T00:00:00Z", "Firmware V14.0.7.0 is listed as a synthetic fixture example.", 1),
    ("t", "1002", "Topic", "u#1002", "02.04.21, 09:32", "2026-01-01T00:00:00Z", "User reports bootloop after flashing recovery. Suggested fix: restore boot.img.", 2),
]
SCHEMA = "topic_id string, post_id string, title string, source_url string, posted_at string, captured_at string, text string, ord long"


def _posts(spark, *texts):
    rows = [("t", str(i), "Topic", f"u#{i}", f"{i % 28 + 1:02d}.04.21, 09:32", "2026-01-01T00:00:00Z", t, i) for i, t in enumerate(texts)] if texts else POSTS
    return spark.createDataFrame(rows, SCHEMA)


def _values(spark, text):
    return {(r["kind"], r["value"]) for r in entities.mentions(entities.with_entities(_posts(spark, text))).collect()}


def test_keyword_search_ranks_the_fix_first(spark):
    found = keyword.search(keyword.build(_posts(spark)), keyword.analyse(spark, [("a", "bootloop boot.img"), ("b", "firmware V 14 0 7 0")]), 5).collect()
    top = {r["query_id"]: r["key"] for r in found if r["rank"] == 1}
    assert top == {"a": "1002", "b": "1001"}
    assert all(abs(r["score"] - r["bm25"] - r["exact"] - r["phrase"]) < 1e-5 for r in found)


def test_index_round_trip(spark, tmp_path):
    index = keyword.build(_posts(spark))
    index.write(str(tmp_path))
    q = keyword.analyse(spark, [("a", "bootloop boot.img")])
    assert keyword.search(keyword.Index.read(spark, str(tmp_path)), q).count() == keyword.search(index, q).count()


def test_chunks(spark):
    text = "\n\n".join("word number one goes here and on. " * 20 for _ in range(3))
    got = corpus.chunks(_posts(spark, text, "  alpha\t\tbeta   gamma\n\n\n\ndelta  ", "", None), 520, 90).collect()
    long = [r for r in got if r["post_id"] == "0"]
    assert len(long) > 1 and all(len(r["text"]) <= 620 for r in long) and long[0]["chunk_id"] == "t:0:chunk-000"
    small = next(r for r in got if r["post_id"] == "1")
    assert small["text"] == "alpha beta gamma\n\ndelta"
    source = "  alpha\t\tbeta   gamma\n\n\n\ndelta  "
    assert source[small["char_start"] : small["char_end"]].split() == small["text"].split()
    assert not [r for r in got if r["post_id"] in ("2", "3")]


def test_vectors_and_hybrid(spark):
    index = keyword.build(_posts(spark))
    q = keyword.analyse(spark, [("a", "bootloop boot.img")])
    for family in ("md5", "blake2b"):
        v = vectors.vectors(index.docs, "key", family=family)
        norms = v.groupBy("key").agg(F.sum(F.col("w") * F.col("w")).alias("n")).collect()
        assert all(abs(r["n"] - 1) < 1e-4 for r in norms)
        found = vectors.search(v, index.docs, q, family=family)
        assert found.orderBy("rank").first()["key"] == "1002"
    both = vectors.hybrid(keyword.search(index, q), found).orderBy("rank").collect()
    assert both[0]["key"] == "1002" and both[0]["score"] == 1.0


def test_entities_positive_and_negative(spark):
    got = _values(spark, "Redmi Note 10 Pro V14.0.7.0 bootloop: restore boot.img, patch boot.img with Magisk, flash recovery.img via fastboot.")
    assert {("device", "Redmi Note 10 Pro"), ("firmware_version", "V14.0.7.0"), ("issue", "bootloop"), ("fix", "restore boot.img"), ("root_action", "patch boot.img"), ("recovery_action", "flash recovery.img"), ("tool", "Magisk"), ("tool", "fastboot")} <= got
    assert ("fix", "restore boot.img") not in _values(spark, "restore it. Later boot.img")
    assert ("root_action", "patch boot.img") not in _values(spark, "magisk cannot start, boot.img with magisk")
    assert ("warning", "do not install recovery.img from aristotle") in _values(spark, "Warning: do not install recovery.img from aristotle")
    assert ("fix", "restore boot.img") in _values(spark, "восстановить boot.img после бутлуп")
    assert _values(spark, "") == set()


def test_relations_and_claims(spark):
    posts = entities.with_entities(_posts(spark, "bootloop: restore boot.img with Magisk", "after update the method with boot.img no longer works", "warning: do not install boot.img from sweet"))
    assert {r["kind"] for r in entities.relations(posts).collect()} >= {"fixes_issue", "warns_about"}
    rows = claims.freshness_windows(claims.claims(posts))
    got = rows.collect()
    assert {r["claim_kind"] for r in got} == {"method", "warning", "status"}
    assert [r["profile_window"] for r in got].count("latest_window") == 1
    made = claims.cross_edges(claims.claims(posts))
    kinds = {r["kind"] for r in made.collect()}
    key = ["kind", "confidence", "manual_review_required"]
    counted = claims.cross_edge_counts(claims.claims(posts)).groupBy("claim_id", *key).agg(F.sum("edges").alias("n"))
    assert {tuple(r) for r in counted.collect()} == {tuple(r) for r in made.groupBy(F.col("from_node").alias("claim_id"), *key).agg(F.count("*").alias("n")).collect()}
    assert {"claim_supersedes_claim", "claim_contradicts_claim", "claim_contextualizes_claim", "claim_deprecated_for_context"} <= kinds


def test_rerank_prefers_structured_evidence(spark):
    posts = entities.with_entities(_posts(spark, "recovery recovery recovery recovery.img talk", "flash recovery.img with fastboot"))
    index, q = keyword.build(posts), keyword.analyse(spark, [("a", "recovery.img recovery")])
    found = keyword.search(index, q)
    edges = entities.relations(posts).select("source_url", "kind", "from_node", "to_node", "confidence")
    out = retrieval.rerank(found, retrieval.context_edges(found, edges), retrieval.intents(q, keyword.specific_terms(index, q))).orderBy("graph_rank").collect()
    assert out[0]["key"] == "1" and out[0]["graph_raw"] > 0


def test_visible_text():
    html = '<div>a<div class="post-block quote">b<br><p>c</p></div><script>x</script>d &amp; e</div><span class="signature">f</span>'
    assert visible_text(html) == "a d & e"
    assert visible_text(None) == ""


def test_answers_are_grounded_and_conflicts_found(spark):
    posts = entities.with_entities(_posts(spark, "bootloop: restore boot.img with Magisk", "warning: do not install boot.img from sweet", "cooking tea"))
    index, q = keyword.build(posts), keyword.analyse(spark, [("a", "bootloop restore boot.img"), ("b", "tea V99.1.2"), ("c", "warning tea")])
    specific, found = keyword.specific_terms(index, q), keyword.search(index, q)
    context = retrieval.context_edges(found, retrieval.edges_of(found, posts, claims.claims(posts)))
    entries = answers.grounding(retrieval.rerank(found, context, retrieval.intents(q, specific)), context, answers.requests(q, specific))
    chain = answers.evidence_chain(entries, context, claims.freshness_windows(claims.claims(posts)))
    report = {r["query_id"]: r for r in answers.conflict_report(entries, chain).collect()}
    assert report["a"]["answer_status"] == "answered" and report["a"]["conflict_status"] == "conflict_detected"
    assert report["b"]["answer_status"] == "insufficient_evidence" and report["b"]["gap_reason"] == "unmatched_structured_query_terms"
    first = chain.where("query_id = 'a' AND step = 1").first()
    assert first["role"] == "primary" and first["answer_kind"].startswith("issue_fix")
    assert not [r for r in entries.where("query_id = 'c' AND key = '2'").collect() if r["grounded"]]


def test_weights_that_cancel_out_give_no_bucket(spark):
    rows = spark.createDataFrame([("a", ["abcdefg", "abcdefg", "abcdefg"])], "key string, tokens array<string>")
    found = {r["bucket"]: r["w"] for r in vectors.vectors(rows, "key", dimensions=2).collect()}
    whole = {}
    for weight, names in ((20, ["tok:abcdefg"]), (6, ["tri:" + "abcdefg"[i : i + 3] for i in range(5)]), (9, ["quad:" + "abcdefg"[i : i + 4] for i in range(4)])):
        for n in names:
            h = vectors._number(n, "md5")
            whole[h % 2] = whole.get(h % 2, 0) + 3 * weight * (1 if h % 2 else -1)
    norm = sum(v * v for v in whole.values()) ** 0.5
    assert found == {b: round(v / norm, 6) for b, v in whole.items() if v}


def test_chunks_of_a_batch_are_handed_on_in_pieces(spark, monkeypatch):
    posts = _posts(spark, *["word number one. " * 200] * 6).coalesce(1)
    whole = sorted(map(tuple, corpus.chunks(posts).collect()))
    monkeypatch.setattr(corpus, "PIECE", 3000)
    sizes = []
    monkeypatch.setattr(type(posts), "mapInArrow", lambda df, run, schema: sizes.extend(b.num_rows for b in run(df.toArrow().to_batches())) or df.select(F.lit("a").alias("topic_id"), F.lit("b").alias("post_id"), F.lit(0).alias("chunk_index")))
    corpus.chunks(posts)
    assert sum(sizes) == len(whole) and max(sizes) <= len(whole) // 6


def test_search_of_tokens_is_that_of_stored_vectors(spark):
    index = keyword.build(_posts(spark, "bootloop restore boot.img", "restore it", "", "tea", None))
    q = keyword.analyse(spark, [("a", "bootloop boot.img"), ("b", "restore tea"), ("c", "")])
    stored = vectors.search(vectors.vectors(index.docs, "key"), index.docs, q)
    assert sorted(map(tuple, vectors.search_tokens(index.docs, q).collect())) == sorted(map(tuple, stored.collect()))


def test_counts_of_nodes_are_the_sizes_of_their_references(spark):
    posts = entities.with_entities(_posts(spark, "bootloop: restore boot.img with Magisk", "warning: do not install boot.img from sweet", "flash boot.img", ""))
    for nodes, counts in ((entities.graph_nodes(posts), entities.graph_node_counts(posts)), (claims.claim_nodes(claims.claims(posts)), claims.claim_node_counts(claims.claims(posts)))):
        columns = ["node_id", "kind", "label", "confidence"]
        assert sorted(map(tuple, nodes.select(*columns, F.size("source_refs").cast("long")).collect())) == sorted(map(tuple, counts.select(*columns, "refs").collect()))


def test_sorts_of_relations_are_those_of_the_pairs(spark):
    rows = claims.claims(entities.with_entities(_posts(spark, "bootloop: restore boot.img with Magisk", "after update the method with boot.img no longer works", "warning: do not install boot.img from sweet", "flash boot.img")))
    asked = spark.createDataFrame([("u#1",), ("u#2",)], "source_url string")
    pairs = claims.cross_edges(rows, asked).withColumn("source_url", F.explode("source_urls")).join(asked, "source_url", "left_semi").select("source_url", "kind", "confidence").distinct()
    got = claims.cross_kinds(rows, asked).collect()
    assert got and len(got) == len(set(got)) and set(got) == set(pairs.collect())


def test_odd_letters_and_blanks_pass_the_quick_tests(spark):
    assert {("device", "Xİaomi 13T"), ("device", "xıaomi 13t pro")} <= _values(spark, "Xİaomi 13T, xıaomi 13t pro")
    row = claims.claims(entities.with_entities(_posts(spark, "maybe  now\t\n boot.img  no longer  works"))).first()
    assert row["evidence"] == "maybe now boot.img no longer works"
