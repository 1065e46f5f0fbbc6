"""Extraction, line dedup, quality, licences, quotations and the pipeline."""

import random

import numpy as np

from tracewell.llm import chat, html_crf, license_scan, line_dedup, quality


def test_crf_on_pages_of_other_seeds():
    chain, rng = html_crf.trained(), random.Random(99)
    wrong = total = 0
    for _ in range(150):
        html, labels = html_crf.labelled_page(rng)
        got = chain.decode(html_crf.features(html_crf.leaf_blocks(html)))
        wrong += sum(a != b for a, b in zip(got, labels))
        total += len(labels)
    assert wrong / total < 0.01


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(20):
        chain = html_crf.Chain(rng.normal(size=1 << html_crf.BITS), rng.normal(size=(2, 2)) * 2)
        slots = [tuple(rng.integers(0, 1 << html_crf.BITS, 3)) for _ in range(7)]
        e = chain.scores(slots)
        value = lambda p: sum(e[i] for i in range(7) if p[i]) + sum(chain.steps[p[i], p[i + 1]] for i in range(6))  # noqa: E731, B023
        best = max(([n >> i & 1 for i in range(7)] for n in range(128)), key=value)
        assert [int(x) for x in chain.decode(slots)] == best


def test_html_extraction(spark):
    html = '<html><head><title>t</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="ad">Buy now.</div><article><h1>Head&nbsp;line</h1><p>First\n  <b>bold</b> &amp; more<br><p>Second</article><div class="comments"><p>Nice one.</p></div><footer>&copy; me</footer></body></html>'
    rows = [(1, "u", html), (2, None, None), (3, "v", ""), (4, "w", "<nav><a href=x>only</a></nav>"), (1, "u", html)]
    got = html_crf.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert text[1] == "Head line\nFirst bold & more\nSecond" and text[2] == text[3] == text[4] == "" and len(got) == 5
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_long_and_deep_pages():
    """Open elements that are never ended, end tags of nothing, and starts that look for something to end."""
    import time

    chain = html_crf.trained()
    n = 20_000
    began = time.process_time()
    for html in ("<article>" + "<b>x y<br>" * n, "<article><p>" + "<i>" * n + "</u>" * n + "text", "<p><div>" + "<b>" * n + "<p>x</p>" * n, "<li>" * n + "x", "<div>" * n + "x" + "</div>" * n):
        blocks = html_crf.leaf_blocks(html)
        assert len(chain.decode(html_crf.features(blocks))) == len(blocks) > 0
    assert time.process_time() - began < 30
    assert chain.text("<article>" + "<b>some words<br>" * n + "</article><footer>&copy; me</footer>") == "\n".join(["some words"] * n)


def test_pages_of_other_layouts():
    """Pages laid out by hand, unlike those that the chain learns from."""
    chain = html_crf.trained()
    table = """<html><body><table><tr><td class="menu"><a href="/">Start</a> <a href="/b">Boards</a></td></tr><tr><td id="content"><h1>On tea</h1>
<p>Tea is a drink that is made by pouring hot water over leaves.</p><ol><li>Boil the water.</li><li>Warm the pot.</li></ol></td></tr>
<tr><td class="footer">Copyright by the authors. <a href="/legal">Legal</a></td></tr></table></body></html>"""
    assert chain.text(table) == "On tea\nTea is a drink that is made by pouring hot water over leaves.\nBoil the water.\nWarm the pot."
    blog = """<body><div class="navbar"><a href=/a>Home</a></div><div class="post"><h2>A day out</h2><p>We went to the lake, and <em>nobody</em> fell in.</p>
<pre>the boat
was   red</pre><div class="share">Share this</div></div><div id="comments"><h3>Comments</h3><p>I was there too, what a day it was.</p></div><footer>Made by hand</footer>"""
    assert chain.text(blog) == "A day out\nWe went to the lake, and nobody fell in.\nthe boat was red"


def test_line_dedup(spark):
    rng = random.Random(4)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n))
    long = say(60)
    varied = lambda: " ".join([*long.split()[:20], say(3), *long.split()[23:]])
    rows = []
    for i in range(12):
        lines = [say(15) for _ in range(6)]
        lines.insert(2, "Page 12 of 99 printed on day %d at noon" % (i * 7))
        if i < 5:
            lines.insert(4, long)
        elif i < 9:
            lines.insert(4, varied())
        rows.append((i, "\n".join(lines), "x"))
    copy = "\n".join(say(15) for _ in range(6))
    rows += [(100 + i, copy, "x") for i in range(6)] + [(200, None, "x"), (201, "", "x"), (202, "short line", "x"), (203, "short line", "x"), (204, "short line", "x")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, n_lines string")).collect()
    out = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for i in range(12):
        assert "Page 12" not in out[i]["text"] and len(out[i]["text"].split("\n")) == 6 and out[i]["n_dropped"] == (2 if i < 9 else 1)
        assert out[i]["text"].split("\n") == [x for x in rows[i][1].split("\n") if len(x.split()) == 15]
    assert all(out[100 + i]["text"] == copy for i in range(6))
    assert out[200]["text"] is None and out[201]["text"] == "" and out[202]["text"] == "short line"
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_dedup_counts_documents(spark):
    rng = random.Random(8)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n))
    head, foot, alone = say(8), say(9), say(7)
    own = lambda: "\n".join(say(4) for _ in range(12))
    rows = [(i, f"{head}\n{own()}\n{foot}") for i in range(3)] + [(10 + i, f"{alone}\n{own()}") for i in range(4)]
    twice = say(11)
    rows += [(20 + i, f"{twice}\n{t}") for i, t in enumerate([*[own()] * 3, *[own()] * 3])]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    dropped = {r["doc_id"]: r["n_dropped"] for r in got}
    assert all(head not in r["text"] and foot not in r["text"] and alone not in r["text"] for r in got)
    assert dropped == {**dict.fromkeys(range(3), 2), **dict.fromkeys(range(10, 14), 1), **dict.fromkeys(range(20, 26), 0)}


def test_line_dedup_against_counting(spark):
    """Ids that are null or repeat, columns with the operator's own inner names, very long lines; counted again in plain Python."""
    rng = random.Random(12)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n))
    pool = [say(rng.choice([3, 5, 8, 12, 30])) for _ in range(25)] + [say(30_000)]
    rows = [(rng.choice([None, *range(60)]), "\n".join(rng.choice(pool) if rng.random() < 0.5 else say(9) for _ in range(rng.randint(1, 8)))) for _ in range(80)]
    rows += [rows[3], (7, None), (None, None), (None, ""), (8, "\n\n")]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in rows], "doc_id long, text string, _lines int, _id int, _content int, n_dropped int")
    got = line_dedup.dedup_lines(docs).collect()
    last = (1 << 63) - 1
    found = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if parsed := line_dedup.parse(line):
                for key in parsed[1]:
                    found.setdefault(key, []).append((last if i is None else i, t))
    first = {k: min(i for i, _ in v) for k, v in found.items() if len({t for _, t in v}) >= 3}

    def plain(i, t):
        if t is None:
            return None
        i, lines, total, recurring, drop = last if i is None else i, t.split("\n"), len(t.split()), 0, set()
        for n, line in enumerate(lines):
            keys = [k for k in (line_dedup.parse(line) or (0, []))[1] if k in first]
            if keys:
                recurring += len(line.split())
                drop.add((n, any(first[k] == i for k in keys)))
        return "\n".join(x for n, x in enumerate(lines) if (n, False) not in drop and ((n, True) not in drop or 2 * recurring >= total))

    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in got))) == sorted(map(repr, ((i, plain(i, t)) for i, t in rows)))
    assert all((r["_lines"], r["_id"], r["_content"]) == (1, 2, 3) for r in got) and sum(r["n_dropped"] for r in got) > 50


def test_rules_agree_with_their_columns(spark):
    rng = random.Random(5)
    good = lambda: ". ".join(" ".join("".join(rng.choice("aeioutnsr") for _ in range(rng.randint(2, 8))) for _ in range(9)).capitalize() for _ in range(6))
    bad = lambda: rng.choice([lambda t: t.upper().replace(" ", "!! "), lambda t: t.replace(" ", "### "), lambda t: (t.split()[0] + " ") * 40])(good())
    texts = [(i, good() if i % 3 else bad(), 1) for i in range(600)] + [(900, None, 1), (901, "", 1), (902, "x" * 100000, 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    scored = quality.add_score(docs.withColumn("_q_upper", docs["score"]), model).collect()
    plain = model.score(np.array([quality.statistics(r["text"]) for r in scored]))
    assert np.allclose([r["score"] for r in scored], plain) and all(0 <= r["score"] <= 1 for r in scored)
    right = [(r["score"] >= 0.5) == bool(r["doc_id"] % 3) for r in scored if r["doc_id"] < 600]
    assert sum(right) / len(right) > 0.97 and 0 < len(model.rules) < 150
    assert quality.train(docs, labels.limit(0)).rules == ()
    assert all(r["score"] == 0.5 for r in quality.add_score(docs, quality.train(docs, labels.limit(0)), "s").selectExpr("s AS score").collect())


def test_license_scan(spark):
    gpl = next(t for n, t in license_scan.TEMPLATES if n == "GPL-3.0" and len(t) > 100)
    rows = [
        (1, "a/LICENSE", gpl), (2, "a/b/code.txt", "nothing here"), (3, "a/b/c/code.txt", "prose about tea.\nLicensed under the Apache License, Version 2.0.\nmore prose"), (4, "z/code.txt", "nothing"), (5, "a/b/c/LICENSE", "Released under the MIT License."),
        (6, "a/b/c/d/x.txt", "prose"), (7, None, "prose"), (8, "a/x", None), (9, "top.txt", ""), (10, "z/code.txt", "the public version of the software is free to use"), (2, "a/b/code.txt", "nothing here"),
    ]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()
    out = {r["doc_id"]: (r["license"], r["how"]) for r in got}
    assert len(got) == len(rows)
    assert out == {1: ("GPL-3.0", "file"), 2: ("GPL-3.0", "inherited"), 3: ("Apache-2.0", "header"), 4: (None, None), 5: ("MIT", "file"), 6: ("MIT", "inherited"), 7: (None, None), 8: ("GPL-3.0", "inherited"), 9: (None, None), 10: (None, None)}
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0


def test_license_scan_of_real_files(spark):
    text = {n: (license_scan.TEXTS / f"{n}.txt").read_text("utf-8") for n in ("MIT", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "MPL-2.0")}
    text["MIT"] = "Copyright 2024 The Tea Authors\n\n" + " ".join(text["MIT"].split("\n\n", 2)[2].split())
    text["BSD-3-Clause"] = "Copyright (c) 1999, Jane Roe\n" + "\n".join(f" * {x}" for x in text["BSD-3-Clause"].split("\n")[2:])
    text["Apache-2.0"] = text["Apache-2.0"].split("APPENDIX")[0]
    text["GPL-2.0"] = text["GPL-2.0"].split("END OF TERMS")[0]
    notice = next(t for n, t in license_scan.TEMPLATES if n == "GPL-3.0" and len(t) > 100).split()
    header = "#!/bin/sh\n#\n" + "\n".join("#  " + " ".join(notice[i : i + 7]) for i in range(0, len(notice), 7)) + "\n#\necho tea\n" + "make a pot of tea\n" * 40
    rows = [(i, f"{n}/LICENSE", t) for i, (n, t) in enumerate(text.items())] + [(20 + i, f"{n}/src/x.py", "print(1)") for i, n in enumerate(text)]
    rows += [(50, "q/run.sh", header), (51, "q/x.py", "print(1)"), (52, "r/LICENSE", text["GPL-3.0"][:600]), (53, "r/x.py", "print(1)"), (0, "MIT/LICENSE", text["MIT"])]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()
    out = {r["doc_id"]: (r["license"], r["how"]) for r in got}
    assert len(got) == len(rows)
    for i, n in enumerate(text):
        assert out[i] == (n, "file") and out[20 + i] == (n, "inherited")
    assert out[50] == ("GPL-3.0", "header") and out[51] == (None, None) and out[52][1] != "file" and out[53] == (None, None)


def test_quotation_links(spark):
    first, second = "The build fails on the new machine.\nIt says that a file is missing.", "Which file is it, and where?"
    rows = [
        (1, 0, "user", first), (1, 1, "assistant", f"On Monday, Ann wrote:\n> The  build fails on the NEW machine.\n> It says that a file is missing.\n\n{second}"), (1, 2, "user", "Unrelated remark of mine."),
        (1, 3, "user", f"> Which file is it, and where?\n>> It says that a file is missing.\nThe one with the keys."), (2, 0, None, "> The build fails on the new machine.\nSame here."), (3, 0, "user", None), (None, None, "user", "> lost quote of nothing at all"), (1, 0, "user", first),
    ]
    got = chat.format_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    out = {(r["conv_id"], r["turn"]): r for r in got}
    assert len(got) == len(rows)
    assert out[1, 1]["text"] == second and (out[1, 1]["parent_conv"], out[1, 1]["parent_turn"]) == (1, 0)
    assert out[1, 3]["text"] == "The one with the keys." and out[1, 3]["parent_turn"] == 1 and out[1, 3]["depth"] == 2 and out[1, 3]["quoted_depth"] == 2
    assert (out[2, 0]["parent_conv"], out[2, 0]["parent_turn"], out[2, 0]["role"]) == (1, 0, "user")
    assert out[3, 0]["text"] == "" and out[None, None]["parent_turn"] is None
    order = [r["turn"] for r in sorted((r for k, r in out.items() if k[0] == 1), key=lambda r: (r["thread_turn"], r["turn"]))]
    assert order == [0, 1, 3, 2]
    chain = [(7, 0, "user", "message number 0 of the chain")] + [(7, i, "user", f"> message number {i - 1} of the chain\nmessage number {i} of the chain") for i in range(1, 40)]
    deep = chat.format_messages(spark.createDataFrame(chain, "conv_id long, turn long, role string, text string")).collect()
    assert {(r["turn"], r["depth"], r["thread_turn"]) for r in deep} == {(i, i, 0) for i in range(40)}
    one = {r["conv_id"]: r for r in chat.conversations(spark.createDataFrame(rows[:4], "conv_id long, turn long, role string, text string")).collect()}
    assert one[1]["n_messages"] == 4 and one[1]["chat"].index("keys") < one[1]["chat"].index("Unrelated")


def test_quotation_holders(spark):
    a, b, c = "the first of the two lines", "the second of the two lines", "a line that stands only here"
    quote = f"> {a}\n> {b}\nI agree."
    rows = [
        (1, 1, a), (1, 2, b), (1, 4, f"{a}\n{b}\nand some more"), (1, 6, quote), (2, 0, quote), (3, 5, f"> {c}\nYes."), (3, 7, c), (4, 2, c), (5, 1, f"> {c}\nNo."),
    ]
    got = chat.format_messages(spark.createDataFrame([(i, t, "user", x) for i, t, x in rows], "conv_id long, turn long, role string, text string")).collect()
    parent = {(r["conv_id"], r["turn"]): (r["parent_conv"], r["parent_turn"]) for r in got}
    assert parent[1, 6] == parent[2, 0] == (1, 4)
    assert parent[3, 5] == (4, 2) and parent[5, 1] == (3, 7)


def test_branching_threads(spark):
    rng = random.Random(3)
    parents = {1: {1: 0, 2: 0, 3: 1}, 2: {i: rng.randrange(i) for i in range(1, 40) if i % 9}, 3: {i: 0 for i in range(1, 5)} | {1500: 0, 2600: 1, 3700: 0, 4000: 1500}}
    rows, expected = [], {}
    for conv, up in parents.items():
        turns = sorted({0, *up, *up.values()} | ({9, 18, 27, 36} if conv == 2 else set()))
        rows += [(conv, t, "user", (f"> message {up[t]} of talk {conv}\n" if t in up else "") + f"message {t} of talk {conv}") for t in turns]
        walk = lambda t: [t, *(x for k in turns if up.get(k) == t for x in walk(k))]  # noqa: E731, B023
        expected[conv] = [x for t in turns if t not in up for x in walk(t)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_messages(messages).collect()
    for conv in parents:
        order = [r["turn"] for r in sorted((r for r in got if r["conv_id"] == conv), key=lambda r: (r["thread_turn"], r["position"]))]
        assert order == expected[conv]
    assert expected[1] == [0, 1, 3, 2]
    chats = {r["conv_id"]: r["chat"] for r in chat.conversations(messages.where("conv_id = 1")).collect()}
    assert [x.split()[1] for x in chats[1].split("\n") if x.startswith("message")] == ["0", "1", "3", "2"]


def test_quotations_of_odd_tables(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_messages(none).count() == 0 and chat.conversations(none).count() == 0
    long = "\n".join(f"line number {i} of a very long message" for i in range(3000))
    rows = [(1, 0, "user", long), (1, 1, "user", "> line number 2999 of a very long message\nI see."), (1, 1, "user", "> line number 2999 of a very long message\nI see."), (1, 2, "user", ">" * 60 + " deep\n> > > \n>"), (2, None, "user", "x"), (None, 3, "user", "x")]
    clash = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "conv_id long, turn long, role string, text string, lines int, own int, depth int, key int")
    got = chat.format_messages(clash).collect()
    assert len(got) == len(rows) and [(r["parent_turn"], r["text"]) for r in got if (r["conv_id"], r["turn"]) == (1, 1)] == [(0, "I see.")] * 2
    assert next(r["quoted_depth"] for r in got if r["turn"] == 2) == 60


def test_jaccard_stage_keeps_one_row_of_each_group(spark):
    import corpus_pipeline as p

    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    base = [words(40) for _ in range(12)]
    near = lambda w: " ".join([*w[:-1], "other"])
    rows = [(3, " ".join(base[0])), (5, " ".join(base[0])), (5, " ".join(base[1])), (9, " ".join(base[1]))]
    rows += [(rng.choice([None, None, *range(20, 40)]), rng.choice([" ".join, near])(rng.choice(base))) for _ in range(60)]
    rows += [(50, None), (50, None), (None, None), (51, ""), (51, "two words"), (None, "two words"), (None, "Two words"), (52, "two words")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = p.ngram_jaccard(spark, docs, "").collect()
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        s = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
        sets[t] = s
    groups = []
    for i, t in rows:
        if sets[t]:
            hit = [g for g in groups if any(100 * len(sets[t] & sets[x]) >= 80 * len(sets[t] | sets[x]) for _, x in g)]
            groups = [g for g in groups if g not in hit] + [sum(hit, []) + [(i, t)]]
    kept = [(r["doc_id"], r["text"]) for r in got]
    assert [x for x in kept if not sets[x[1]]].__len__() == sum(not sets[t] for _, t in rows)
    full = [x for x in kept if sets[x[1]]]
    assert len(full) == len(groups)
    for g in groups:
        own = [x for x in full if x in g]
        ids = [i for i, _ in g if i is not None]
        assert len(own) == 1 and own[0][0] == (min(ids) if ids else None)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as p

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as p

    rng = random.Random(6)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    notice = "This notice is on every page of the site number 5"
    texts = [say(40) + "\n" + notice + "\n" + say(20) for _ in range(120)]
    texts += [texts[0], texts[1] + " one"] + [t.upper().replace(" ", "!! ") for t in texts[:60]]
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(900, None, None, None, None), (901, "", "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 122), 0) for i in range(182)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in p.STAGES:
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(now)
        if name != p.STAGES[-1][0]:
            assert now.columns == p.COLUMNS
    ids = [{r["doc_id"] for r in k.select("doc_id").collect()} for k in kept]
    assert ids[0] >= set(range(122)) and len(ids[0] & set(range(122, 182))) < 4
    assert all(notice not in (r["text"] or "") for r in kept[1].collect()) and ids[1] == ids[0]
    assert ids[2] == ids[1] - {120, 121}
    assert ids[3] == ids[2]
    assert p.run(spark, str(tmp_path)).count() == kept[3].count()
