"""Pages as sources: markup to text, titles and links."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Visible(HTMLParser):
    """Text outside scripts, styles, signatures, edit notes and quote blocks."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _VOID:
            return
        words = {w for k, v in attrs if k == "class" for w in (v or "").split()}
        ignored = tag in ("script", "style") or bool(words & {"edit", "post-edit-reason", "signature"}) or {"post-block", "quote"} <= words
        if self.depth or ignored:
            self.depth += 1

    def handle_endtag(self, tag: str) -> None:
        if self.depth and tag not in _VOID:
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if not self.depth and data.strip():
            self.parts.append(data.strip())


def visible_text(html: str | None) -> str:
    p = _Visible()
    p.feed(html or "")
    p.close()
    return " ".join(re.sub("-{10,}", " ", unescape(" ".join(p.parts))).split())


def texts(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, text): visible text of each page. Nested elements to skip aren't regular, so this is an Arrow function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([visible_text(h.as_py()) for h in b.column(1)], pa.string())], names=[key, "text"])

    return pages.select(key, html).mapInArrow(run, f"{key} {pages.schema[key].dataType.simpleString()}, text string")


def _resolved(c: Column) -> Column:
    """Text with the basic references resolved."""
    for ref, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(ref), F.lit(char))
    return c


def _plain(c: Column) -> Column:
    """Markup of flat elements to text: tags go, basic references are resolved, white space becomes one space."""
    return F.trim(F.regexp_replace(_resolved(F.regexp_replace(c, "<[^>]*>", " ")), r"\s+", " "))


def title(html: Column, default: str = "Untitled topic") -> Column:
    """The first h1, else the title, else a default."""
    first = lambda tag: F.nullif(_plain(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)), F.lit(""))
    return F.coalesce(first("h1"), first("title"), F.lit(default))


def links(pages: DataFrame, key: str = "page_id", base: str | None = None) -> DataFrame:
    """(key, ord, url, anchor_text): the anchors of each page, each address once, in order.

    The address may be quoted either way or not at all, and its references are resolved; with a base, relative ones are joined to it, and ones
    that begin with a host or a path come out whole.
    """
    anchors = F.regexp_extract_all("html", F.lit(r"""(?is)<a\s[^>]*?href\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)[^>]*>.*?</a>"""), F.lit(0))
    rows = pages.select(key, F.posexplode(anchors).alias("ord", "a"))
    href = F.regexp_extract("a", r"""(?is)href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    rows = rows.select(key, "ord", F.trim(_resolved(F.regexp_replace(href, r"""^["']|["']$""", ""))).alias("url"), _plain(F.regexp_extract("a", r"(?is)<a\s[^>]*>(.*?)</a>", 1)).alias("anchor_text"))
    rows = rows.where("url <> ''")
    if base:
        u, host = F.col("url"), F.lit("/".join(base.split("/")[:3]))
        whole = F.when(u.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), u).when(u.startswith("//"), F.concat(F.lit(base.split(":")[0] + ":"), u)).when(u.startswith("/"), F.concat(host, u)).when(u.startswith("?"), F.concat(F.lit(base.split("?")[0]), u)).when(u.startswith("#"), F.concat(F.lit(base.split("#")[0]), u)).otherwise(F.concat(F.lit(base.split("?")[0].rsplit("/", 1)[0] + "/"), u))
        rows = rows.withColumn("url", whole)
    return rows.groupBy(key, "url").agg(F.min(F.struct("ord", "anchor_text")).alias("f")).select(key, "f.ord", "url", "f.anchor_text")


def bare_links(pages: DataFrame, hosts: tuple[str, ...], key: str = "page_id") -> DataFrame:
    """(key, ord, url): addresses of some hosts that stand in a page as text or in scripts, each once, in order."""
    any_of = "|".join(re.escape(h) for h in hosts)
    found = F.regexp_extract_all(_resolved(F.col("html")), F.lit(rf"""https?://(?:www\.)?(?:{any_of})/[^\s"'<>]+"""), F.lit(0))
    rows = pages.select(key, F.posexplode(found).alias("ord", "url"))
    return rows.groupBy(key, "url").agg(F.min("ord").alias("ord")).select(key, "ord", "url")
