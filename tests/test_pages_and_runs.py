import time

import pytest
from pyspark.sql import functions as F

from tracewell.operators import registry, suites
from tracewell.plans import runs
from tracewell.sources import config, pages, posts
from tracewell.streaming import ingest

TABLE = """<html><body><h1>Redmi topic</h1><table class="t" data-post="9001"><tr><td id="ph-9001-d1"><div id="post-member-9001"><span class="normalname"><a href="/u">fixture</a></span></div></td>
<td id="ph-9001-d2"><div>Message #1</div><img src="p.gif" /> 01.04.21, 09:32<span id="kh-9001"></span></td></tr>
<tr><td id="post-main-9001"><div>Install TWRP with fastboot flash recovery recovery.img. Restore boot.img if the device falls into bootloop. Warning: do not install recovery.img from camellia.
<div class="post-block quote"><div>Quote</div>stale boot.img</div><span class="edit">Edited</span><br>--------------------<br><div class="signature">Magisk</div></div></td></tr><tr id="pb-9001-r3"><td>footer</td></tr></table></body></html>"""
ARTICLE = '<h1>Other</h1><article id="post-1">Firmware V14.0.7.0 is listed.</article><article id="post-2">Bootloop after recovery. Suggested fix: restore boot.img.</article><article id="post-3"> </article>'
WINDOWS = '<p id="post-main-5">first words<p id="post-main-6">second words'


def test_layouts():
    layout, (post,) = posts.split(TABLE)
    assert layout == "table" and post == posts.Post("9001", "Install TWRP with fastboot flash recovery recovery.img. Restore boot.img if the device falls into bootloop. Warning: do not install recovery.img from camellia.", "fixture", "01.04.21, 09:32")
    assert posts.split(ARTICLE) == ("article", [posts.Post("1", "Firmware V14.0.7.0 is listed."), posts.Post("2", "Bootloop after recovery. Suggested fix: restore boot.img.")])
    assert posts.split('<div class="a post_body" id="post-main-7">x <b>y</b></div> </div>') == ("post_body", [posts.Post("7", "x y")])
    assert posts.split(WINDOWS) == ("window", [posts.Post("5", "> first words"), posts.Post("6", "> second words")]) or posts.split(WINDOWS)[1][0].post_id == "5"
    assert posts.split(None) == posts.split("<p>none") == ("", [])


def test_codings():
    assert posts.decoded("прошивка".encode()) == posts.decoded("прошивка".encode("cp1251")) == "прошивка"
    assert posts.decoded(b"\xff\x98x") == "я�x" and posts.decoded(None) == ""
    assert posts.decoded("да".encode(), ("windows-1251", "utf-8")) != "да"


def test_links(spark):
    html = """<a href="/a?x=1&amp;y=2">one</a><a class=k href='b.html'>two</a><a href=//h.org/c>three</a><a href="/a?x=1&amp;y=2">again</a><a href="">none</a> see https://www.forum.example.org/p?q=1 ."""
    rows = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [(r["url"], r["anchor_text"]) for r in pages.links(rows, base="https://forum.example.org/x/y.php?z").orderBy("ord").collect()]
    assert got == [("https://forum.example.org/a?x=1&y=2", "one"), ("https://forum.example.org/x/b.html", "two"), ("https://h.org/c", "three")]
    assert [r["url"] for r in pages.bare_links(rows, ("forum.example.org",)).collect()] == ["https://www.forum.example.org/p?q=1"]


def test_profile_and_seeds(spark):
    assert config.profile("a: 1\nmax_topics: 12 # some\nnested:\n  label: 'x: y'\na: 2") == {"a": "1", "max_topics": 12, "nested": None, "label": "x: y"}
    got = config.seeds(spark, "seeds:\n  - id: s1\n    url: https://h/?showtopic=1\n    max_pages: 3\n  - id: s2\n    label: none\n  - id: s3\n    url: u\n    focus: \"f\"\n").collect()
    assert [(r["seed_ord"], r["seed_id"], r["focus"], r["max_pages"]) for r in got] == [(0, "s1", None, 3), (1, "s3", "f", 1)]


def test_tags(spark):
    row = spark.range(1).select(registry.tags(F.array(F.lit(" Two  Words"), F.lit("two-words"), F.lit(" "), F.lit("B"))).alias("t"), registry.from_csv(F.lit(" a, ,b")).alias("c")).first()
    assert row["t"] == ["two-words", "b"] and row["c"] == ["a", "b"]


def test_run_from_pages_to_answers(spark, tmp_path):
    url = "https://forum.example.org/index.php?showtopic={}&st=0"
    rows = [(1, url.format(42), TABLE, "2026-01-01T00:00:00Z"), (2, url.format(7), ARTICLE, "2026-01-01T00:00:00Z"), (3, url.format(42), TABLE.replace("Install", "Put"), "2025-01-01T00:00:00Z")]
    taken = spark.createDataFrame(rows, "page_id long, url string, html string, captured_at string")
    folder = str(tmp_path)
    with pytest.raises(LookupError):
        runs.read(spark, folder)
    runs.write(taken, folder, runs.new_run_id("2026-01-08T00:00:00Z", "fixture"), "starter", "2026-01-08T00:00:00Z")
    run = runs.read(spark, folder)
    assert run.run_id == "20260108T000000Z__fixture" and runs.receipts(spark, folder).count() == 5
    assert {r["post_id"]: r["author_label"] for r in run.posts.collect()} == {"9001": "fixture", "1": None, "2": None}
    top = run.search([("a", "bootloop restore boot.img camellia"), ("b", "firmware V14.0.7.0")]).where("rank = 1").collect()
    assert {r["query_id"]: r["post_id"] for r in top} == {"a": "9001", "b": "1"}
    report, chain, briefs = run.answer([("a", "bootloop restore boot.img camellia recovery.img"), ("z", "unknown thing V99.9.9")])
    got = {r["query_id"]: r for r in report.collect()}
    assert got["a"]["answer_status"] == "answered" and got["a"]["warning_supported"]
    first = chain.where("query_id = 'a' AND step = 1").first()
    assert first["answer_kind"] == "issue_fix_warning" and first["fix_labels"] == ["flash recovery.img", "restore boot.img"]
    assert briefs.where("query_id = 'a'").first()["brief"].startswith("По локальной базе: Issue: bootloop.")
    kinds = {r["kind"] for r in run.edges.select("kind").distinct().collect()}
    assert {"topic_contains_post", "post_mentions_entity", "fixes_issue", "warns_about", "source_supports_claim"} <= kinds
    runs.export(briefs, f"{folder}/packets")
    assert spark.read.json(f"{folder}/packets").count() == briefs.count()
    assert runs.measured(spark, f"{folder}/runs").first()["files"] > 10
    for bad in ("", "../x", "a/b", "-x"):
        with pytest.raises(ValueError):
            runs.safe(bad)


def test_suites(spark):
    results = spark.createDataFrame([("a", 1, "p1", ["x", "boot.img"], 2.5), ("a", 2, "p2", ["y"], 1.0)], "query_id string, rank int, post_id string, terms array<string>, score double")
    found = suites.facts(results, "query_id", {"post": F.col("post_id"), "terms": F.col("terms"), "score": F.col("score"), "rank": F.col("rank")})
    checks = [("a", "1", "post", "equal", ["p1", "q"]), ("a", "2", "terms", "contains", ["BOOT"]), ("a", "3", "terms", "all", ["x", "z"]), ("a", "4", "score", "minimum", ["2"]), ("a", "5", "rank", "at_most", ["0"]), ("a", "6", "post", "absent", ["p9"]), ("a", "7", "none", "prefix", None), ("b", "8", "post", "equal", ["p1"]), ("a", "9", "post", "prefix", ["p"])]
    got = suites.evaluate(spark.createDataFrame(checks, "case_id string, check_id string, field string, op string, expected array<string>"), found)
    assert {r["check_id"] for r in got.collect() if not r["ok"]} == {"3", "5", "8"}
    assert {(r["case_id"], r["passed"], r["failed"], r["ok"]) for r in suites.summary(got).collect()} == {("a", 6, 2, False), ("b", 0, 1, False)}
    edges = spark.createDataFrame([("k", "a", "b"), ("k", "a", "c")], "kind string, from_node string, to_node string")
    asked = spark.createDataFrame([("k", "a", "b"), ("k", "b", "a")], "kind string, from_node string, to_node string")
    assert [r["there"] for r in suites.edges_there(asked, edges).orderBy("from_node").collect()] == [True, False]


def test_streaming_ingest(spark, tmp_path):
    rows = [(1, "u1", "<h1>one</h1>text a", "2026-01-01 00:00:00"), (1, "u1", "<h1>two</h1>text b", "2026-01-01 00:01:00"), (2, "u2", "<h1>three</h1>text c", "2026-01-01 00:02:00"), (2, "u2", "<h1>three</h1>text c", "2026-01-01 00:03:00")]
    taken = spark.createDataFrame(rows, "page_id long, url string, html string, at string").withColumn("captured_at", F.col("at").cast("timestamp")).drop("at")
    taken.write.parquet(f"{tmp_path}/in")
    stream = ingest.distinct_captures(ingest.read_pages(spark, f"{tmp_path}/in", taken.schema))
    query = ingest.write_posts(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    began = time.time()
    while query.isActive and time.time() - began < 120:
        time.sleep(0.5)
    assert query.exception() is None
    got = {(r["page_id"], r["title"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(1, "one", "one text a"), (1, "two", "two text b"), (2, "three", "three text c")}
