"""Entities of posts by rule packs, and the relations between entities of one post."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions import rules as R
from tracewell.operators.stages import once

_TYPE = "array<struct<kind:string,value:string>>"


def _flags(flags: str) -> str:
    return f"(?{flags}U)"


def _clean(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def _entity(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.alias("value"))


def _hints(text: Column, low: Column) -> Column:
    """Cheap tests of a text, a field for each: a rule whose test fails can't match, so it isn't tried.

    odd: letters that match another one without regard to case, but aren't that in lower case. With them no test by letters counts for such rules.
    """
    any_of = lambda *words: reduce(or_, [low.contains(w) for w in words])
    tests = {
        "odd": reduce(or_, [text.contains(x) for x in "\u0130\u0131\u017f\u212a"]), "device": any_of("redmi", "xiaomi"), "poco": any_of("poco"), "model": low.rlike(r"\p{Nd}{4}\p{L}"), "dotted": low.rlike(r"\p{Nd}\.\p{Nd}"), "hyperos": any_of("hyperos"),
        "build": text.rlike(r"[A-Z0-9]\.[A-Z0-9]+\.[A-Z0-9]"), "restore": any_of("restore", "восстанов", "верн"), "flash": any_of("flash", "прош"), "patch": any_of("patch", "патч"), "tool": any_of("magisk", "ksu", "kernel"), "recovery": any_of("recovery.img"), "with": any_of("fastboot", "twrp", "orange"),
        "marked": any_of("warning", "важно", "не ставить"),
    }
    return F.struct(*[c.alias(n) for n, c in tests.items()])


#: The test of each rule in R.PATTERNS, and whether it goes by letters.
_NEEDS = [("device", True), ("poco", True), ("model", False), ("dotted", False), ("hyperos", True), ("dotted", False), ("build", False)]


def _matches(text: Column, may: Column, kind: str, pattern: str, flags: str, form: str) -> Column:
    shape = {"keep": _clean, "upper": F.upper, "lower": F.lower}[form]
    return F.when(may, F.transform(F.regexp_extract_all(text, F.lit(_flags(flags) + pattern), F.lit(0)), lambda m: _entity(kind, shape(m)))).otherwise(F.array().cast(_TYPE))


def _spelled(low: Column) -> Column:
    """Which of the rules' words a text has, in one pass; none of them is the beginning or the end of two others side by side."""
    any_of = "|".join(sorted({w for _, w, _ in [*R.WORDS, *R.ISSUES]}, key=len, reverse=True))
    return F.array_distinct(F.regexp_extract_all(low, F.lit(rf"(?U)\b(?:{any_of})\b"), F.lit(0)))


def _words(spelled: Column, words: list[tuple[str, str, str]]) -> Column:
    return F.array_compact(F.array(*[F.when(F.array_contains(spelled, w), _entity(k, F.lit(n))) for k, w, n in words]))


def _first(found: Column) -> Column:
    """The first of those with the same kind and, but for case, the same value."""
    return F.filter(found, lambda x, i: ~F.exists(F.slice(found, F.lit(1), i), lambda y: (y["kind"] == x["kind"]) & (F.lower(y["value"]) == F.lower(x["value"]))))


def _files(text: Column) -> Column:
    return F.array_distinct(F.concat(*[F.transform(F.regexp_extract_all(text, F.lit(_flags(f) + p), F.lit(0)), F.lower) for p, f in R.FILES]))


def _found(text: Column, low: Column, files: Column, spelled: Column, hints: Column) -> Column:
    """ARRAY<STRUCT<kind, value>> in the order of the rules, then of place; files, words and hints are given, for several rules use them."""
    codenames = F.array_compact(F.array(*[F.when(F.array_contains(spelled, w), w) for k, w, _ in R.WORDS if k == "codename"]))
    quoted = lambda f: F.regexp_replace(f, r"([.\-])", r"\\$1")
    seen = lambda *parts: F.regexp_like(low, F.concat(F.lit("(?U)"), *[F.lit(p) if isinstance(p, str) else p for p in parts]))
    value = lambda c: F.transform(c, lambda f: f)

    found = [_matches(text, hints[need] | hints["odd"] if by_letters else hints[need], *r) for (need, by_letters), r in zip(_NEEDS, R.PATTERNS, strict=True)]
    found.append(_words(spelled, R.WORDS))
    found.append(F.transform(value(files), lambda f: _entity("file", f)))
    found.append(_words(spelled, R.ISSUES))
    fixes = lambda f: F.array_compact(F.array(F.when(hints["restore"] & seen(R.RESTORE, quoted(f)), _entity("fix", F.concat(F.lit("restore "), f))), F.when(hints["flash"] & seen(R.FLASH, quoted(f)), _entity("fix", F.concat(F.lit("flash "), f)))))
    found.append(F.flatten(F.transform(files, fixes)))

    tool, patched = rf"\b{R.ROOT_TOOL}\b", rf"\b{R.PATCHED}\b"
    rooted = lambda f: f.isin(R.ROOT_FILES) & ((hints["patch"] & (seen(patched, "[^.?!]{0,120}", quoted(f)) | seen(quoted(f), "[^.?!]{0,120}", patched))) | (hints["tool"] & (seen(quoted(f), "[^.?!]{0,120}", tool) | seen(tool, "[^.?!]{0,120}", quoted(f))) & ~low.rlike("(?U)" + R.ROOT_FAILS)))
    flashed, with_tool = rf"\b{R.FLASHED}\b", rf"\b{R.RECOVERY_TOOL}\b"
    recovery = r"recovery\.img"
    recovers = hints["recovery"] & (hints["flash"] | hints["with"]) & low.rlike("(?U)" + "|".join([flashed + "[^.?!]{0,120}" + recovery, recovery + "[^.?!]{0,160}" + flashed, recovery + "[^.?!]{0,160}" + with_tool, recovery + ".{0,240}" + with_tool + ".{0,120}" + flashed, recovery + ".{0,240}" + flashed + ".{0,120}" + with_tool]))
    sorted_files = F.array_sort(files)
    found.append(F.transform(F.filter(sorted_files, rooted), lambda f: _entity("root_action", F.concat(F.lit("patch "), f))))
    found.append(F.transform(F.filter(sorted_files, lambda f: (f == "recovery.img") & recovers), lambda f: _entity("recovery_action", F.concat(F.lit("flash "), f))))

    warned = lambda f: F.transform(F.filter(codenames, lambda c: hints["marked"] & seen(R.WARNS, quoted(f), r".{0,80}(?:от|from)\s+", c)), lambda c: _entity("warning", F.concat(F.lit("do not install "), f, F.lit(" from "), c)))
    found.append(F.flatten(F.transform(files, warned)))
    return F.filter(F.concat(*[f.cast(_TYPE) for f in found]), lambda x: x["value"] != "")


def with_entities(posts: DataFrame) -> DataFrame:
    """Posts with the column entities. Each step is worked out once for a post, whatever reads it; posts without files or words skip the rules for these."""
    rows = once(posts, "_low", F.lower("text"))
    rows = once(once(rows, "_files", _files(F.col("text"))), "_spelled", _spelled(F.col("_low")))
    rows = once(rows, "_hints", _hints(F.col("text"), F.col("_low")))
    rows = once(rows, "_found", _found(F.col("text"), F.col("_low"), F.col("_files"), F.col("_spelled"), F.col("_hints")))
    return once(rows, "entities", _first(F.col("_found"))).drop("_low", "_files", "_spelled", "_hints", "_found")


def mentions(posts: DataFrame) -> DataFrame:
    """(post_id, source_url, seq, kind, value) of posts with entities."""
    return posts.select("post_id", "source_url", F.posexplode("entities").alias("seq", "e")).select("post_id", "source_url", "seq", "e.kind", "e.value")


def node_id(kind: Column, value: Column) -> Column:
    return F.concat(F.lit("entity:"), kind, F.lit(":"), value)


def relations(posts: DataFrame) -> DataFrame:
    """(edge_id, kind, from_node, to_node, source_url, post_id, confidence): pairs of entities of one post that a rule relates.

    The entities of a post are in its row, so pairs are made there and nothing is shuffled until edges are made unique.
    """
    e = F.col("entities")

    def related(kind: str, source: str, targets: list[str], need, confidence: float) -> Column:
        def fits(a: Column, b: Column) -> Column:
            if need == "in":
                return F.lower(a["value"]).contains(F.lower(b["value"]))
            return b["value"].isin(need) if need else F.lit(True)

        def edges(a: Column) -> Column:
            ends = F.filter(e, lambda b: b["kind"].isin(targets) & fits(a, b))
            return F.transform(ends, lambda b: F.struct(F.lit(kind).alias("kind"), node_id(a["kind"], a["value"]).alias("from_node"), node_id(b["kind"], b["value"]).alias("to_node"), F.lit(confidence).alias("confidence")))

        return F.flatten(F.transform(F.filter(e, lambda a: a["kind"] == source), edges))

    parts = [related(*r) for r in R.RELATIONS]
    rows = posts.select("post_id", "source_url", F.explode(F.array_distinct(F.concat(*parts))).alias("x")).select("post_id", "source_url", "x.*")
    edge = F.concat("from_node", F.lit("->"), "to_node", F.lit(":"), "kind", F.lit(":post:"), "post_id")
    return rows.select(edge.alias("edge_id"), "kind", "from_node", "to_node", "source_url", "post_id", "confidence").dropDuplicates(["edge_id"])


def graph_nodes(posts: DataFrame) -> DataFrame:
    """(node_id, kind, label, source_refs, confidence) of topics, posts and entities; an entity's references in the order of posts."""
    topics = posts.groupBy("topic_id").agg(F.max_by("title", "ord").alias("label")).select(F.concat(F.lit("topic:"), "topic_id").alias("node_id"), F.lit("topic").alias("kind"), "label", F.array().cast("array<string>").alias("source_refs"), F.lit(1.0).alias("confidence"))
    own = posts.select(F.concat(F.lit("post:"), "post_id").alias("node_id"), F.lit("post").alias("kind"), F.concat(F.lit("Post "), "post_id").alias("label"), F.array("source_url").alias("source_refs"), F.lit(1.0).alias("confidence"))
    found = posts.select("ord", "source_url", F.explode("entities").alias("e")).groupBy("e.kind", "e.value").agg(F.array_sort(F.collect_set(F.struct("ord", "source_url"))).alias("refs"))
    ents = found.select(node_id(F.col("kind"), F.col("value")).alias("node_id"), "kind", F.col("value").alias("label"), F.array_distinct(F.transform("refs", lambda r: r["source_url"])).alias("source_refs"), F.lit(0.6).alias("confidence"))
    return topics.unionByName(own).unionByName(ents)


def graph_node_counts(posts: DataFrame) -> DataFrame:
    """graph_nodes with refs, the number of references of a node, instead of their list, which holds most addresses for a common entity."""
    fixed = graph_nodes(posts.withColumn("entities", F.filter("entities", lambda x: F.lit(False)))).withColumn("refs", F.size("source_refs").cast("long")).drop("source_refs")
    found = posts.select("source_url", F.explode("entities").alias("e")).groupBy("e.kind", "e.value").agg(F.countDistinct("source_url").alias("refs"))
    return fixed.unionByName(found.select(node_id(F.col("kind"), F.col("value")).alias("node_id"), "kind", F.col("value").alias("label"), F.lit(0.6).alias("confidence"), "refs"))


def structural_edges(posts: DataFrame) -> DataFrame:
    """(edge_id, kind, from_node, to_node, source_url, post_id, confidence): topic to post and post to entity."""
    topic, post = F.concat(F.lit("topic:"), "topic_id"), F.concat(F.lit("post:"), "post_id")
    a = posts.select(F.lit("topic_contains_post").alias("kind"), topic.alias("from_node"), post.alias("to_node"), "source_url", "post_id", F.lit(1.0).alias("confidence"))
    b = posts.select("post_id", "source_url", F.explode("entities").alias("e")).select(F.lit("post_mentions_entity").alias("kind"), F.concat(F.lit("post:"), "post_id").alias("from_node"), node_id(F.col("e.kind"), F.col("e.value")).alias("to_node"), "source_url", "post_id", F.lit(0.6).alias("confidence"))
    both = a.unionByName(b)
    return both.select(F.concat("from_node", F.lit("->"), "to_node").alias("edge_id"), *both.columns)
