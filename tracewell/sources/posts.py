"""Posts out of forum pages: bytes to text, the layouts that a page may have, and the fields of a post."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tracewell.sources.pages import visible_text

CODINGS = ("utf-8", "windows-1251")
#: Characters of a post's text at most where a layout has no end of its own, and of the markup that is read for it.
MOST_TEXT, MOST_MARKUP = 8000, 12000


def decoded(content: bytes | None, codings: Sequence[str] = CODINGS) -> str:
    """Text by the first coding that fits; where none does, by windows-1251 with marks for what isn't in it."""
    for name in codings:
        try:
            return (content or b"").decode(name)
        except UnicodeDecodeError:
            pass
    return (content or b"").decode("windows-1251", "replace")


def decode_pages(pages: DataFrame, key: str = "page_id", content: str = "content", codings: Sequence[str] = CODINGS) -> DataFrame:
    """(key, html) of pages with bytes. Links are read with the codings the other way round, as their pages are."""
    codings = tuple(codings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decoded(c.as_py(), codings) for c in b.column(1)], pa.string())], names=[key, "html"])

    return pages.select(key, content).mapInArrow(run, f"{key} {pages.schema[key].dataType.simpleString()}, html string")


def _pattern(text: str) -> re.Pattern:
    return re.compile(text, re.I | re.S)


# The marks of the layouts and of the fields. N stands for the number of a post.
_TABLE = _pattern(r"""<table[^>]+data-post=["'](\d+)["'][^>]*>(.*?)(?=<table[^>]+data-post=["']\d+["']|</body>|</html>|\Z)""")
_BODY = _pattern(r"""<div[^>]+class=["'][^"']*post_body[^"']*["'][^>]*id=["']post-main-(\d+)["'][^>]*>(.*?)</div>\s*</div>""")
_ARTICLE = _pattern(r"""<article[^>]+id=["']post-(\d+)["'][^>]*>(.*?)</article>""")
_START = _pattern(r"""id=["']post-main-(\d+)["']""")
_FIELDS = {
    "text": r"""id=["']post-main-N["'][^>]*>(.*?)(?=</td>\s*</tr>\s*<tr[^>]+id=["']pb-N-r3["']|</table>)""",
    "author_label": r"""id=["']post-member-N["'][^>]*>.*?<span[^>]+class=["'][^"']*normalname[^"']*["'][^>]*>\s*<a[^>]*>(.*?)</a>""",
    "posted_at": r"""id=["']ph-N-d2["'][^>]*>.*?</div>\s*<img[^>]*>\s*([^<]+?)\s*<span[^>]+id=["']kh-N["']""",
}


@dataclass(frozen=True)
class Post:
    post_id: str
    text: str
    author_label: str | None = None
    posted_at: str | None = None


def _field(name: str, number: str, block: str) -> str | None:
    found = _pattern(_FIELDS[name].replace("N", number)).search(block)
    return visible_text(found[1]) if found else None


def _tables(html: str) -> Iterator[Post]:
    for number, block in _TABLE.findall(html):
        yield Post(number, (_field("text", number, block) or "")[:MOST_TEXT], _field("author_label", number, block), _field("posted_at", number, block))


def _elements(pattern: re.Pattern) -> Callable[[str], Iterator[Post]]:
    return lambda html: (Post(number, visible_text(block)) for number, block in pattern.findall(html))


def _windows(html: str) -> Iterator[Post]:
    """Each post from its mark to the next one's."""
    marks = list(_START.finditer(html))
    ends = [m.start() for m in marks[1:]] + [min(len(html), marks[-1].end() + MOST_MARKUP)] if marks else []
    for mark, end in zip(marks, ends):
        yield Post(mark[1], visible_text(html[mark.end() : end])[:MOST_TEXT])


#: In this order; the first one that gives posts with a text is the page's.
LAYOUTS: tuple[tuple[str, Callable[[str], Iterator[Post]]], ...] = (("table", _tables), ("post_body", _elements(_BODY)), ("article", _elements(_ARTICLE)), ("window", _windows))


def split(html: str | None) -> tuple[str, list[Post]]:
    """The layout of a page and its posts; no posts, no layout."""
    for name, read in LAYOUTS:
        if posts := [p for p in read(html or "") if p.text]:
            return name, posts
    return "", []


def page_posts(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, layout, ord, post_id, author_label, posted_at, text) of pages(key, html). A layout is tried on the whole page, so this is an Arrow function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                place, rows = [], []
                for i, html in enumerate(part.column(1)):
                    layout, posts = split(html.as_py())
                    place += [i] * len(posts)
                    rows += [(layout, n, p.post_id, p.author_label, p.posted_at, p.text) for n, p in enumerate(posts)]
                kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(place, pa.int64())), *columns], names=[key, "layout", "ord", "post_id", "author_label", "posted_at", "text"])

    return pages.select(key, "html").mapInArrow(run, f"{key} {pages.schema[key].dataType.simpleString()}, layout string, ord int, post_id string, author_label string, posted_at string, text string")
