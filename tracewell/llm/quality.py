"""Quality classifier: a sparse ensemble of rules from tree paths, weighted by lasso logistic regression.

Shallow trees are grown on bootstrap samples of labelled rows; each path from a root to a node is a rule, a conjunction of bounds on
statistics of the text. Lasso logistic regression over the rules keeps few of them. The model is compiled into one Spark column over the
statistics, so scoring is a projection after one pass over the texts.

The only gathered rows are the statistics of at most SAMPLE labelled rows, those with the smallest hashes of their ids. Labels, lang,
source and the id are never inputs of a score.

Defined results: null and empty texts have the statistics 0 (ratios 0) and get the score that the rules give for those. Labels that are
null are left out; an id with several labels counts by their mean. Without labels the score is 0.5; with labels of one kind only it
is the smoothed share of that kind. Repeated rows get the same score, further columns are kept by add_score, and one with the score's own
name is replaced.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tracewell.llm.spark_util import unused

SAMPLE, TREES, DEPTH, LASSO, THRESHOLD = 20_000, 40, 3, 2e-3, 0.3
STATISTICS = ["n_bytes", "n_words", "word_bytes", "upper", "digits", "bangs", "pipes", "symbols", "stops", "distinct", "repeats", "line_words", "longest_word", "wide"]
_UPPER, _DIGITS, _SYMBOLS = bytes(range(65, 91)), b"0123456789", b"#$%&*+/<=>@[\\]^_`{}~"


def statistics(text: str | None) -> tuple[float, ...]:
    """Statistics of one whole text, in the order of STATISTICS."""
    raw = (text or "").encode()
    words = raw.split()
    n, w = len(raw), len(words)
    if not w:
        return (float(n), *[0.0] * (len(STATISTICS) - 1))
    without = lambda some: n - len(raw.translate(None, some))
    return (
        float(n),
        float(w),
        sum(map(len, words)) / w,
        without(_UPPER) / n,
        without(_DIGITS) / n,
        raw.count(b"!") / w,
        raw.count(b"|") / w,
        without(_SYMBOLS) / n,
        (raw.count(b".") + raw.count(b",")) / w,
        len(set(words)) / w,
        sum(map(operator.eq, words, words[1:])) / w,
        w / (raw.count(b"\n") + 1),
        float(max(map(len, words))),
        (n - len(text)) / n,
    )


def with_statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """All columns of docs and one for each statistic, and the names of these."""
    names = [unused(f"_q_{s}", docs.columns) for s in STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([statistics(t.as_py()) for t in b.column(at)], np.float64).reshape(b.num_rows, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c) for c in found.T)], names=[*kept, *names])

    kept, at = docs.columns, docs.columns.index(text_col)
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *(StructField(n, DoubleType()) for n in names)])), names


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is at most, bound); a bound not kept from above is kept from below."""

    bounds: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for i, most, bound in self.bounds:
            out &= (x[:, i] <= bound) if most else (x[:, i] > bound)
        return out

    def column(self, columns: Sequence[Column]) -> Column:
        out = F.lit(True)
        for i, most, bound in self.bounds:
            out = out & ((columns[i] <= bound) if most else (columns[i] > bound))
        return out


@dataclass(frozen=True)
class Model:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for r, w in zip(self.rules, self.weights):
            z += w * r.holds(x)
        return 1 / (1 + np.exp(-z))

    def column(self, columns: Sequence[Column]) -> Column:
        z = F.lit(self.intercept)
        for r, w in zip(self.rules, self.weights):
            z = z + F.when(r.column(columns), F.lit(w)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _tree(x: np.ndarray, y: np.ndarray, allowed: np.ndarray, depth: int, path: tuple, cuts: list[np.ndarray], out: set) -> None:
    """Grows a tree by Gini impurity and adds the path to each of its nodes."""
    if path:
        out.add(Rule(tuple(sorted(path))))
    p = y.mean()
    if depth == 0 or len(y) < 40 or p in (0.0, 1.0):
        return
    best = (1e-4, -1, 0.0)
    whole = p * (1 - p)
    for i in allowed:
        if not len(cuts[i]):
            continue
        bins = np.searchsorted(cuts[i], x[:, i])
        n = np.cumsum(np.bincount(bins, minlength=len(cuts[i]) + 1))[:-1]
        s = np.cumsum(np.bincount(bins, y, len(cuts[i]) + 1))[:-1]
        m, t = len(y) - n, y.sum() - s
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = whole - (s * (n - s) / n + t * (m - t) / m) / len(y)
        gain = np.where((n >= 10) & (m >= 10), gain, 0)
        j = int(gain.argmax())
        if gain[j] > best[0]:
            best = (float(gain[j]), int(i), float(cuts[i][j]))
    _, i, bound = best
    if i < 0:
        return
    left = x[:, i] <= bound
    _tree(x[left], y[left], allowed, depth - 1, (*path, (i, True, bound)), cuts, out)
    _tree(x[~left], y[~left], allowed, depth - 1, (*path, (i, False, bound)), cuts, out)


def _lasso(a: np.ndarray, y: np.ndarray, strength: float, steps: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty on all but the intercept, by accelerated proximal gradients."""
    n, d = a.shape
    m = np.hstack([a, np.ones((n, 1))])
    v = np.ones(d + 1)
    for _ in range(20):  # the largest eigenvalue bounds the curvature
        v = m.T @ (m @ v)
        v /= np.linalg.norm(v)
    step = 4 * n / max(float(np.linalg.norm(m @ v) ** 2), 1e-9)
    w = z = np.zeros(d + 1)
    t = 1.0
    for _ in range(steps):
        g = m.T @ (1 / (1 + np.exp(-(m @ z))) - y) / n
        new = z - step * g
        new[:d] = np.sign(new[:d]) * np.maximum(np.abs(new[:d]) - step * strength, 0)
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        z, w = new + (before - 1) / t * (new - w), new
    return w[:d], float(w[d])


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Model:
    if not len(y):
        return Model((), (), 0.0)
    share = (y.sum() + 1) / (len(y) + 2)
    if y.min() == y.max():
        return Model((), (), math.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 66)[1:-1])) for c in x.T]
    found: set[Rule] = set()
    for _ in range(TREES):
        rows = rng.integers(0, len(y), len(y))
        _tree(x[rows], y[rows], rng.permutation(x.shape[1])[: max(4, x.shape[1] // 2)], DEPTH, (), cuts, found)
    columns: dict[bytes, tuple[Rule, np.ndarray]] = {}
    for r in sorted(found, key=lambda r: (len(r.bounds), r.bounds)):
        h = r.holds(x)
        if 0.002 <= h.mean() <= 0.998:
            columns.setdefault(h.tobytes(), (r, h))
    if not columns:
        return Model((), (), math.log(share / (1 - share)))
    a = np.stack([h for _, h in columns.values()], 1).astype(np.float64)
    w, b = _lasso(a, y, LASSO)
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    rules = [r for r, _ in columns.values()]
    return Model(tuple(rules[i] for i in kept), tuple(float(w[i]) for i in kept), b)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on labelled rows outside the held-out fifth, at most `sample` of them."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("_label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows, names = with_statistics(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id"))
    rows = rows.drop("text").dropDuplicates().orderBy(F.xxhash64("doc_id"), "doc_id", *names).limit(sample)
    got = rows.select("_label", *names).collect()
    data = np.array(got, np.float64).reshape(-1, 1 + len(STATISTICS))
    return fit_rules(data[:, 1:], data[:, 0])


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def add_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of docs and the score; a column that already has its name is replaced."""
    own = [c for c in docs.columns if c.lower() != name.lower()]
    found, names = with_statistics(docs.select(*[F.col(f"`{c}`") for c in own]))
    return found.select(*[F.col(f"`{c}`") for c in own], model.column([F.col(n) for n in names]).alias(name))
