"""Main text of HTML pages by a linear-chain conditional random field over the leaf blocks of the page.

A page is read into leaf blocks: runs of text between the starts and ends of block elements and line breaks, each with the elements
around it. Every block gets binary features of its ancestors' tags and class words, and of its text, and the chain says for each block
whether it belongs to the article. Weights are learned by maximum likelihood (forward-backward) on labelled pages that this module makes from a
fixed seed; decoding is by Viterbi. Reading takes time and memory in
proportion to the page, whatever its length and depth.

Defined results: null and empty pages, and pages without article blocks, have the empty text. Repeated rows and ids are taken as they
come; further columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 13
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_HIDDEN = frozenset("script style noscript template head title svg math iframe object canvas select textarea option button".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose start ends an open element of the same name (an end tag may be left out).
_CLOSING = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_SPACE = re.compile(r"[ \t\n\r\f\v   -     　]+")
_WORD = re.compile(r"[a-z]+")


#: A start tag looks for an element to end no further up than the nearest of these.
_BOUNDS = frozenset("ul ol table div article section dl blockquote".split())


class _Element:
    """An open element. What its blocks inherit is kept as shared sets, so a page takes memory in proportion to its length, however deep."""

    __slots__ = ("tag", "names", "inner", "depth", "bound", "around")

    def __init__(self, tag: str, words: Sequence[str], above: _Element | None, place: int) -> None:
        names = above.names if above else frozenset()
        new = {"tag:" + tag, *("word:" + w for w in words)}
        self.tag, self.names = tag, names if new <= names else names | new
        block = tag not in _INLINE
        self.inner = tag if block else above.inner if above else ""
        self.depth = min(6, (above.depth if above else 0) + (block and tag not in ("html", "body")))
        self.bound = place if tag in _BOUNDS else above.bound if above else -1
        self.around: tuple[int, ...] | None = None


def _around(element: _Element | None) -> tuple[int, ...]:
    """Slots of the ancestors' tags and class words; the innermost block element counts as a feature of its own."""
    element = element or _NOWHERE
    if element.around is None:
        names = element.names | {"inner:" + element.inner, f"depth:{element.depth}"}
        if "tag:article" not in names and "tag:main" not in names:
            names |= {"outside"}
        element.around = tuple(sorted(map(_slot, names)))
    return element.around


class _Blocks(HTMLParser):
    """Collects (text, innermost open element, share of link text) for each leaf block, in time linear in the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Element] = []
        self.at: dict[str, list[int]] = defaultdict(list)  # the places of the open elements of each name
        self.out: list[tuple[str, _Element | None, float]] = []
        self.text: list[str] = []
        self.hidden = self.linked = self.link_chars = 0

    def cut(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip(" ")
        if text:
            self.out.append((text, self.open[-1] if self.open else None, min(1.0, self.link_chars / len(text))))
        self.text, self.link_chars = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in _INLINE:
            self.cut()
        if tag in _VOID:
            return
        if tag in _CLOSING:
            last = max((self.at[t][-1] for t in _CLOSING[tag] if self.at.get(t)), default=-1)
            if last > (self.open[-1].bound if self.open else -1):
                self._pop(last)
        words = [w for k, v in attrs if k in ("class", "id", "role") and v for w in _WORD.findall(v.lower())]
        self.at[tag].append(len(self.open))
        self.open.append(_Element(tag, words, self.open[-1] if self.open else None, len(self.open)))
        self.hidden += tag in _HIDDEN
        self.linked += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.at.get(tag):
            if tag not in _INLINE:
                self.cut()
            self._pop(self.at[tag][-1])

    def _pop(self, i: int) -> None:
        while len(self.open) > i:
            tag = self.open.pop().tag
            self.at[tag].pop()
            self.hidden -= tag in _HIDDEN
            self.linked -= tag == "a"

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.text.append(data)
            if self.linked:
                self.link_chars += len(data.strip())


def leaf_blocks(html: str | None) -> list[tuple[str, _Element | None, float]]:
    p = _Blocks()
    p.feed(html or "")
    p.close()
    p.cut()
    return p.out


@lru_cache(maxsize=1 << 14)
def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) & (1 << BITS) - 1


_NOWHERE = _Element("", (), None, -1)
_NOWHERE.names, _NOWHERE.inner, _NOWHERE.depth = frozenset(), "", 0


def features(blocks: Sequence[tuple[str, _Element | None, float]]) -> list[tuple[int, ...]]:
    out = []
    for i, (text, element, linked) in enumerate(blocks):
        n = len(text)
        names = [f"chars:{min(9, n.bit_length())}", f"links:{int(linked * 4)}", "end:" + (text[-1] if text[-1] in ".!?:;|" else "other"), "bias"]
        if "©" in text or "·" in text:
            names.append("sign")
        if i == 0:
            names.append("first")
        if i == len(blocks) - 1:
            names.append("last")
        out.append((*_around(element), *map(_slot, names)))
    return out


class Chain:
    """Two labels; a weight for each feature slot (of the article label) and for each step from label to label."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray) -> None:
        self.weights, self.steps = weights, steps

    def scores(self, slots: list[tuple[int, ...]]) -> np.ndarray:
        w = self.weights
        return np.array([w[list(s)].sum() for s in slots])

    def decode(self, slots: list[tuple[int, ...]]) -> list[bool]:
        """The likeliest labels, by Viterbi."""
        if not slots:
            return []
        (s00, s01), (s10, s11) = self.steps.tolist()
        back, off, on = [], 0.0, 0.0
        for i, e in enumerate(self.scores(slots).tolist()):
            if i:
                from_off, from_on = (off + s00, on + s10), (off + s01, on + s11)
                back.append((from_off[1] > from_off[0], from_on[1] > from_on[0]))
                off, on = max(from_off), max(from_on)
            on += e
        out = [on > off]
        for b in reversed(back):
            out.append(b[out[-1]])
        return out[::-1]

    def text(self, html: str | None) -> str:
        blocks = leaf_blocks(html)
        return "\n".join([b[0] for b, on in zip(blocks, self.decode(features(blocks))) if on])


def _gradient(chain: Chain, slots: list[tuple[int, ...]], labels: np.ndarray, g: np.ndarray, gs: np.ndarray) -> None:
    """Adds observed minus expected counts of one page, by forward-backward."""
    e = np.stack([np.zeros(len(slots)), chain.scores(slots)], 1)
    n = len(slots)
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    alpha[0] = e[0]
    for i in range(1, n):
        alpha[i] = np.logaddexp(alpha[i - 1][0] + chain.steps[0], alpha[i - 1][1] + chain.steps[1]) + e[i]
    for i in range(n - 2, -1, -1):
        x = beta[i + 1] + e[i + 1]
        beta[i] = np.logaddexp(chain.steps[:, 0] + x[0], chain.steps[:, 1] + x[1])
    z = np.logaddexp(*alpha[-1])
    p = np.exp(alpha[:, 1] + beta[:, 1] - z)
    for s, d in zip(slots, labels - p):
        g[list(s)] += d
    for i in range(1, n):
        gs -= np.exp(alpha[i - 1][:, None] + chain.steps + (e[i] + beta[i])[None, :] - z)
        gs[int(labels[i - 1]), int(labels[i])] += 1


def fit(pages: Sequence[tuple[str, Sequence[bool]]], rounds: int = 12, rate: float = 0.25, decay: float = 1e-4) -> Chain:
    """Stochastic gradient ascent (with a step for each slot) on the penalised likelihood of labelled pages."""
    data = []
    for html, labels in pages:
        slots = features(leaf_blocks(html))
        if len(slots) != len(labels):
            raise ValueError("a label is needed for each block")
        if slots:
            data.append((slots, np.array(labels, float)))
    chain = Chain(np.zeros(1 << BITS), np.zeros((2, 2)))
    seen, seen_steps = np.full(1 << BITS, 1e-3), np.full((2, 2), 1e-3)
    for _ in range(rounds):
        for slots, labels in data:
            g, gs = np.zeros(1 << BITS), np.zeros((2, 2))
            _gradient(chain, slots, labels, g, gs)
            g -= decay * chain.weights
            seen += g * g
            seen_steps += gs * gs
            chain.weights += rate * g / np.sqrt(seen)
            chain.steps += rate * gs / np.sqrt(seen_steps)
    return chain


def labelled_page(rng: random.Random) -> tuple[str, list[bool]]:
    """A page in one of many layouts with the label of each of its blocks."""
    html: list[str] = []
    labels: list[bool] = []
    words = ["".join(rng.choice("aeioubcdfglmnrst") for _ in range(rng.randint(1, 9))) for _ in range(40)]
    say = lambda a, b: " ".join(rng.choice(words) for _ in range(rng.randint(a, b))).capitalize()
    mark = lambda s: s + rng.choice([".", ".", ".", "!", "!!", "***", " |", ""])

    def block(open_: str, close: str, text: str, main: bool) -> None:
        html.append(open_ + text + close)
        labels.append(main)

    def links(n: int) -> None:
        html.append("<ul>")
        for _ in range(n):
            block(f'<li><a href="/{rng.choice(words)}">', "</a></li>", say(1, 3), False)
        html.append("</ul>")

    def aside(kind: str) -> None:
        name = {"nav": ["nav", "menu", "navbar", "breadcrumb"], "ad": ["ad", "ads", "advert", "banner", "sponsored", "promo"], "side": ["sidebar", "related", "widget", "aside"], "notice": ["cookie", "notice", "consent", "newsletter", "popup"], "comment": ["comments", "comment", "reply", "disqus"], "share": ["share", "social", "tags", "meta", "byline"]}[kind]
        tag = {"nav": ["nav", "div", "nav"], "side": ["aside", "div"], "comment": ["section", "div"]}.get(kind, ["div", "div", "section", "p"])
        t = rng.choice(tag)
        attr = rng.choice(["class", "class", "id"])
        html.append(f'<{t} {attr}="{rng.choice(name)}">' if rng.random() < 0.9 or t not in ("nav", "aside") else f"<{t}>")
        if kind == "nav":
            links(rng.randint(2, 7))
        elif kind in ("ad", "notice", "share") or t == "p":
            block("", "", mark(say(2, 25)), False)
        else:
            if rng.random() < 0.5:
                block("<h3>", "</h3>", say(1, 4), False)
            if rng.random() < 0.5 and kind == "side":
                links(rng.randint(2, 5))
            else:
                for _ in range(rng.randint(1, 4)):
                    block("<p>", "</p>", mark(say(3, 40)), False)
        html.append(f"</{t}>")

    html.append(f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{say(2, 8)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>")
    bare = rng.random() < 0.1  # nothing before the article
    if not bare and rng.random() < 0.4:
        html.append("<header>")
        block(rng.choice(["<h1>", "<div>", "<p>"]), "", say(1, 5), False)
        html.append("</header>")
    if not bare and rng.random() < 0.85:
        aside("nav")
    for kind in rng.sample(["ad", "notice", "side", "share"], 0 if bare else rng.randint(0, 3)):
        aside(kind)
    shell = rng.choice(["article", "article", "article", "main", "div class=content", 'div id="post"', 'div class="article-body"', "section class=entry", 'div class="main"', 'div class="post"', 'div class="entry-content"', 'td id="content"', 'div class="story"'])
    html.append(f"<{shell}>")
    if rng.random() < 0.8:
        name = rng.choice(["h1", "h1", "h1", "h2"])
        block(f"<{name}>", f"</{name}>", say(2, 12), True)
    for _ in range(rng.randint(1, 9)):
        r = rng.random()
        text = mark(say(3, 120) if r < 0.8 else say(1, 4))
        if r > 0.93:
            aside(rng.choice(["ad", "share", "side"]))
        elif r > 0.88:
            block("<h2>", "</h2>", say(1, 6), True)
        elif r > 0.84:
            html.append("<ul>")
            for _ in range(rng.randint(1, 4)):
                block("<li>", "</li>", mark(say(2, 15)), True)
            html.append("</ul>")
        elif r > 0.80:
            block("<blockquote>", "</blockquote>", text, True)
        elif r > 0.76:
            block("<p>", "</p>", f'{say(2, 9)} <a href="/x">{say(1, 3)}</a> {say(2, 20)}.', True)
        elif r > 0.7:
            block("<p><b>", "<br>", text, True)
        elif r > 0.67:
            block("<pre>", "</pre>", text, True)
        elif r > 0.64:
            html.append("<ol>")
            for _ in range(rng.randint(1, 4)):
                block("<li>", "</li>", mark(say(2, 15)), True)
            html.append("</ol>")
        elif r > 0.61:
            block(rng.choice(["<br>", "<br><b>"]), "<br>", text, True)
            html.append("</b>")
        else:
            block("<p>", rng.choice(["</p>", "</p>", ""]), text, True)
    if rng.random() < 0.15:
        html.append("<form>")
        block("<label>", "</label>", say(1, 4), False)
        html.append("<input><button>Send</button></form>")
    html.append(f"</{shell.split()[0]}>")
    for kind in rng.sample(["comment", "side", "ad", "nav", "share"], rng.randint(0, 3)):
        aside(kind)
    if rng.random() < 0.85:
        html.append("<footer>")
        block(rng.choice(["", "<p>", "<div>"]), "", rng.choice(["&copy; ", "", "&copy; 2020 "]) + say(1, 3) + rng.choice([" &middot; ", " "]) + mark(say(2, 20)), False)
        html.append("</footer>")
    html.append("</body></html>")
    return "".join(html), labels


@lru_cache(maxsize=1)
def trained(pages: int = 500, seed: int = 3) -> Chain:
    rng = random.Random(seed)
    return fit([labelled_page(rng) for _ in range(pages)])


def extract(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages(page_id, url, html)."""
    chain = chain or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [chain.text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
