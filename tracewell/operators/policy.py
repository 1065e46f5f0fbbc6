"""URL policy, canonical addresses, sources and crawl plans. Hosts, paths and denied tokens are parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    hosts: tuple[str, ...] = ("forum.example.org",)
    path: str = "/index.php"
    needed: str = "showtopic="
    denied: tuple[str, ...] = field(default=("act=search", "act=Search", "act=findpost", "act=attach", "act=login", "act=Login", "act=auth", "act=usercp", "act=post", "act=Post", "act=report", "act=warn"))
    denied_paths: tuple[str, ...] = ("/dl", "/lofiversion/")


def part(url: Column, name: str, key: str | None = None) -> Column:
    return F.try_parse_url(url, F.lit(name), *([F.lit(key)] if key else []))


def allowed(url: Column, policy: Policy = Policy()) -> Column:
    """True for addresses of public topics; false, never null, for everything else."""
    query, path = F.coalesce(part(url, "QUERY"), F.lit("")), F.coalesce(part(url, "PATH"), F.lit(""))
    joined = F.concat(path, F.lit("?"), query)
    ok = part(url, "PROTOCOL").isin("http", "https") & part(url, "AUTHORITY").isin(*policy.hosts) & (path == policy.path) & query.contains(policy.needed)
    for token in (*policy.denied, *policy.denied_paths):
        ok = ok & ~joined.contains(token)
    return F.coalesce(ok, F.lit(False))


def _key(url: Column, name: str, default: str) -> Column:
    return F.coalesce(F.nullif(part(url, "QUERY", name), F.lit("")), F.lit(default))


def topic_id(url: Column) -> Column:
    return _key(url, "showtopic", "unknown")


def page_start(url: Column) -> Column:
    return _key(url, "st", "0")


def canonical(url: Column) -> Column:
    return F.concat(part(url, "PROTOCOL"), F.lit("://"), part(url, "AUTHORITY"), part(url, "PATH"), F.lit("?showtopic="), _key(url, "showtopic", ""), F.lit("&st="), page_start(url))


def page_url(url: Column, index: Column, per_page: int = 20) -> Column:
    start = F.coalesce(page_start(url).try_cast("int"), F.lit(0)) + index * per_page
    return F.concat(F.regexp_replace(canonical(url), "&st=.*$", "&st="), start.cast("string"))


def crawl_plan(seeds: DataFrame, max_topics: int) -> DataFrame:
    """(seed_id, page_index, page_start, url): the pages of the first seeds; seeds has seed_ord, seed_id, url and max_pages."""
    rows = seeds.where(F.col("seed_ord") < max_topics).where("max_pages > 0")
    rows = rows.select("seed_id", "url", F.explode(F.sequence(F.lit(0), F.col("max_pages") - 1)).alias("page_index"))
    url = page_url(F.col("url"), F.col("page_index"))
    return rows.select("seed_id", "page_index", page_start(url).alias("page_start"), url.alias("url"))


def select_sources(sources: DataFrame, refs: list[str] | None = None, kinds: list[str] | None = None, tags: list[str] | None = None, enabled_only: bool = True) -> DataFrame:
    out = sources.where(F.coalesce("enabled", F.lit(True))) if enabled_only else sources
    if refs:
        out = out.where(F.lower("source_ref").isin([r.lower() for r in refs]))
    if kinds:
        out = out.where(F.col("kind").isin(kinds))
    if tags:
        out = out.where(F.arrays_overlap(F.transform("tags", F.lower), F.array(*[F.lit(t.lower()) for t in tags])))
    return out


def source_id(kind: Column, ref: Column) -> Column:
    return F.concat(F.lit("src-"), F.substring(F.sha2(F.concat(kind, F.lit(":"), F.lower(ref)), 256), 1, 16))


def preflight_errors(steps: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """(source_id, source_ref, error_code): what stands against crawling each step."""
    ref = F.coalesce("source_ref", F.lit(""))
    start = page_start(ref).try_cast("int")
    bad = lambda c: F.coalesce(c, F.lit(True))
    codes = [(bad(F.col("kind") != "topic"), "unsupported_source_kind"), (bad(F.col("access") != "public"), "unsupported_access_mode"), (bad(F.col("include_media") != "none"), "media_download_disabled"), (~allowed(ref, policy), "outside_public_topic_policy"), (start.isNull() | (start < 0), "invalid_topic_offset")]
    return steps.select("source_id", ref.alias("source_ref"), F.explode(F.array_compact(F.array(*[F.when(c, code) for c, code in codes]))).alias("error_code"))
