"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Rotations are learned by iterative quantisation on a bounded sample: alternating between the signs of the rotated vectors and the best
rotation towards them. Near copies count once in it. A bit is set where a rotated coordinate is above the sample's median, so codes are balanced. Slices of the code are
the keys of several hash tables. Each table is probed with the key and, within Hamming radius 1, with the key whose least certain bit is turned. Vectors
that meet are compared by the Hamming distance of the whole codes, and those within a radius by their original values in double precision.

The width of a slice and the number of tables are measured, not assumed: pairs exactly at the threshold are made from the sample, with differences in
random directions and in directions in which the sample itself varies, and those of the sample that are near it are added. For each width as many
tables are taken as bring the recall of the worst kind of pairs to RECALL, and of the widths the one with the least work for this number of vectors. So
slices grow with the table, and data that lie in few directions get the tables that they need. The radius is the largest distance of these pairs.

Equal vectors are one with a weight. Buckets with more than BLOCK vectors are cut into blocks, and each pair of blocks is a task of its
own; smaller buckets share tasks. A pair counts in the first table only in which it meets, so counts add up over tables, and a task emits counts and a
spanning forest of what it linked, not pairs. Buckets of one vector end at a count: only their hashes were shuffled.

Defined results: vectors that are null, zero, or hold null or non-finite values link with nothing. Vectors of different lengths don't link;
each length has an index of its own. Repeated rows with one id and the same values are one vector, but each row is returned. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.spark_util import components, cut, join_by_count

THRESHOLD, SAMPLE, RECALL, BLOCK, ROUNDS = 0.95, 4096, 0.98, 512, 25
#: Bits that are learned at most, and pairs of each kind that the tables are measured with.
BITS, PAIRS = 2048, 1500
#: Rows and pairs that a task takes together.
_ROWS, _CHUNK = 2048, 1 << 18
#: Rough costs of a row of a table, of a vector that is sent to a bucket, and of a compared pair.
_PER_ROW, _PER_VECTOR, _PER_PAIR = 2.0, 15.0, 0.3
_U = np.uint64


def learn_rotations(x: np.ndarray, count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Projections (dimensions x bits) and the median of each bit."""
    d = x.shape[1]
    centred = x - x.mean(0) if len(x) else x
    basis = np.linalg.svd(centred, full_matrices=True)[2].T if len(x) > 1 else np.eye(d)
    v = centred @ basis
    out = []
    rng = np.random.default_rng(seed)
    for _ in range(count):
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(ROUNDS if len(x) > 1 else 0):
            u, _, w = np.linalg.svd(np.sign(v @ r).T @ v)
            r = (u @ w).T
        out.append(basis @ r)
    projection = np.hstack(out)
    return projection, np.median(x @ projection, axis=0) if len(x) else np.zeros(projection.shape[1])


def thinned(x: np.ndarray, threshold: float) -> np.ndarray:
    """Unit vectors without those close to an earlier one, so that no median lies inside a large group of near copies and cuts it up."""
    kept, open_ = [], np.ones(len(x), bool)
    for i in range(len(x)):
        if open_[i]:
            kept.append(i)
            open_ &= x @ x[i] < threshold
    return x[kept]


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def threshold_pairs(x: np.ndarray, threshold: float, near: np.ndarray | None = None, seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Kinds of pairs at the threshold: x turned in any direction, x turned in a direction between two others, and pairs of `near` itself close to it."""
    rng = np.random.default_rng(seed)
    if not len(x):
        return []
    a = x[rng.integers(0, len(x), PAIRS)]
    kinds = [rng.normal(size=a.shape)]
    if len(x) > 2:
        kinds.append(x[rng.integers(0, len(x), PAIRS)] - x[rng.integers(0, len(x), PAIRS)])
    out = []
    for u in kinds:
        u = u - (u * a).sum(1, keepdims=True) * a
        length = np.sqrt((u * u).sum(1, keepdims=True))
        ok = length[:, 0] > 1e-9
        out.append((a[ok], threshold * a[ok] + np.sqrt(1 - threshold**2) * u[ok] / length[ok]))
    if near is not None and len(near) > 1:
        s = near[:2048] @ near[:2048].T
        i, j = np.nonzero(np.triu((s >= threshold) & (s < threshold + (1 - threshold) / 4), 1))
        if len(i) >= 50:
            taken = rng.permutation(len(i))[:PAIRS]
            out.append((near[i[taken]], near[j[taken]]))
    return [p for p in out if len(p[0])]


@dataclass(frozen=True)
class Index:
    """Tables over vectors of one length."""

    projection: np.ndarray
    middle: np.ndarray
    width: int
    tables: int
    radius: int

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of unit vectors: the key in each table, and the bit of it that is the least certain, as numbers."""
        away = (x @ self.projection - self.middle).reshape(len(x), self.tables, self.width)
        powers = 1 << np.arange(self.width, dtype=np.int64)
        return (away > 0) @ powers, powers[np.abs(away).argmin(2)]


def _met(differ: np.ndarray, weak_a: np.ndarray, weak_b: np.ndarray) -> np.ndarray:
    return (differ == 0) | (differ == weak_a) | (differ == weak_b)


def learn(x: np.ndarray, n: int, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 11) -> Index:
    """Index for n vectors of which x, unit vectors, are a sample. One half of it turns the axes, the other measures what that gives."""
    d = x.shape[1]
    spread = thinned(x, threshold)
    half = spread[::2] if len(spread) > 64 else spread
    projection, middle = learn_rotations(half, max(1, -(-BITS // d)), seed)
    bits = projection.shape[1]
    spread = spread[1::2] if len(spread) > 64 else spread
    kinds = []
    for a, b in threshold_pairs(spread, threshold, x):
        a, b = a @ projection - middle, b @ projection - middle
        kinds.append((np.abs(a), np.abs(b), (a > 0) != (b > 0)))
    own = (spread[:2048] @ projection - middle) > 0
    best, rate, at = None, 0.5, 1
    for width in range(1, 49):
        count = bits // width
        cut_ = lambda z: z[:, : count * width].reshape(len(z), count, width)  # noqa: E731, B023
        tables = 1
        for a, b, differ in kinds:
            wrong = cut_(differ)
            number = wrong.sum(2)
            weak = np.take_along_axis(wrong, cut_(a).argmin(2)[..., None], 2)[..., 0] | np.take_along_axis(wrong, cut_(b).argmin(2)[..., None], 2)[..., 0]
            found = np.logical_or.accumulate((number == 0) | (number == 1) & weak, 1).mean(0)
            enough = np.flatnonzero(found >= recall)
            tables = max(tables, int(enough[0]) + 1) if len(enough) and tables <= count else count + 1
        if tables > count:
            continue
        if len(own) > 1:  # the rate at which two of the sample share a key; where that is too rare to count, it goes on falling as before
            keys = cut_(own)[:, : min(count, 8)] @ (1 << np.arange(width, dtype=np.int64))
            same = np.mean([(c * (c - 1)).sum() for c in (np.unique(k, return_counts=True)[1] for k in keys.T)])
            if same >= 40:
                rate, at = same / len(own) / (len(own) - 1), width
        shared = 3 * max(rate ** (width / at), 2.0**-62)
        work = tables * (2 * n * _PER_ROW + 2 * n * min(1.0, n * shared) * _PER_VECTOR + n * n / 2 * shared * _PER_PAIR)
        if best is None or work < best[0]:
            best = (work, width, tables)
    _, width, tables = best
    radius = max((int(differ[:, : width * tables].sum(1).max()) for _, _, differ in kinds), default=width * tables)
    return Index(projection[:, : width * tables], middle[: width * tables], width, tables, radius)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _places(keys: np.ndarray, dim: int) -> np.ndarray:
    """Hashes of (length, table, key)."""
    table = _mix(np.arange(keys.shape[1]).astype(_U) + _U(dim << 20))
    return _mix(keys.astype(_U) + table).view(np.int64)


class _Group:
    """Rows of one or more buckets: vectors with their codes, each in the bucket of its key or as a probe."""

    def __init__(self, group: pd.DataFrame, threshold: float, radius: int) -> None:
        group = group.sort_values("h", kind="stable")
        self.threshold, self.radius = threshold, radius
        self.bucket, self.table, self.probe = (group[c].to_numpy() for c in ("h", "t", "probe"))
        self.node, self.weight, self.own = (group[c].to_numpy() for c in ("node", "weight", "own"))
        self.keys, self.weak = np.stack(group["keys"].to_numpy()), np.stack(group["weak"].to_numpy())
        self.x = unit(np.stack(group["v"].to_numpy()))
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def first_met(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs of rows whose codes are within the radius and that meet here first, once for each pair of vectors."""
        flag = ~(self.probe[a] & self.probe[b])
        a, b = a[flag], b[flag]
        differ = self.keys[a] ^ self.keys[b]
        near = np.bitwise_count(differ).sum(1) <= self.radius
        a, b, differ = a[near], b[near], differ[near]
        met = _met(differ, self.weak[a], self.weak[b])
        t = self.table[a]
        new = met.argmax(1) == t
        # Both may have turned the same bit; then only the probe of the smaller one counts.
        here = np.arange(len(a)), t
        both = (differ[here] == self.weak[a][here]) & (differ[here] == self.weak[b][here])
        prober, other = np.where(self.probe[a], self.node[a], self.node[b]), np.where(self.probe[a], self.node[b], self.node[a])
        new &= (differ[here] == 0) | ~both | (prober < other)
        return np.stack([a[new], b[new]])

    def small(self) -> None:
        """All pairs within buckets, by their distance in the sorted rows."""
        n, kept, held = len(self.bucket), [], 0
        most = int(np.diff(np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1], [True]]))).max())
        for k in range(1, most):
            i = np.flatnonzero(self.bucket[:-k] == self.bucket[k:])
            kept.append(np.stack([i, i + k]))
            held += len(i)
            if held >= _CHUNK or k == most - 1:
                a, b = self.first_met(*np.hstack(kept))
                near = np.einsum("ij,ij->i", self.x[a], self.x[b]) >= self.threshold
                self.found.append((a[near], b[near]))
                kept, held = [], 0

    def blocks(self, i: int, j: int) -> None:
        """Pairs of two blocks of a large bucket, by one product."""
        left = np.flatnonzero(self.own == i)
        right = left if i == j else np.flatnonzero(self.own == j)
        near = self.x[left] @ self.x[right].T >= self.threshold
        a, b = np.nonzero(np.triu(near, 1) if i == j else near)
        self.found.append(tuple(self.first_met(left[a], right[b])))

    def linked(self) -> pd.DataFrame:
        """The weight that each vector is newly linked with, and the smallest one that it hangs together with."""
        a, b = (np.concatenate([f[k] for f in self.found]).astype(np.int64) if self.found else np.zeros(0, np.int64) for k in (0, 1))
        node, where = np.unique(self.node, return_inverse=True)
        links = np.bincount(where[a], self.weight[b], len(node)) + np.bincount(where[b], self.weight[a], len(node))
        a, b = where[a], where[b]
        low = np.arange(len(node))
        while len(a):
            new = low.copy()
            np.minimum.at(new, a, low[b])
            np.minimum.at(new, b, low[a])
            new = new[new]
            if (new == low).all():
                break
            low = new
        has = np.flatnonzero(links > 0)
        return pd.DataFrame({"node": node[has], "links": links[has].astype(np.int64), "low": node[low[has]]})


def _compare(group: pd.DataFrame, threshold: float, radius: dict[int, int]) -> pd.DataFrame:
    i, j, dim = (int(group[c].iloc[0]) for c in ("i", "j", "dim"))
    g = _Group(group, threshold, radius[dim])
    if i < 0:
        g.small()
    else:
        g.blocks(i, j)
    return g.linked()


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of vectors(vec_id, embedding)."""
    given = vectors.schema["embedding"].dataType.simpleString()
    kind = "float" if given == "array<float>" else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(odd, F.lit(False)) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("node", F.when(sound, F.xxhash64(F.transform("v", lambda x: x + F.lit(0.0).cast(kind)))))
    ids = cut(rows.select("vec_id", "node"))
    weights = ids.where("node IS NOT NULL").distinct().groupBy("node").agg(F.count("*").alias("weight"), F.min("vec_id").alias("low"))
    distinct = cut(rows.where("node IS NOT NULL").groupBy("node").agg(F.first("v").alias("v")).join(weights, "node").withColumn("dim", F.size("v")))

    indexes: dict[int, Index] = {}
    for r in distinct.groupBy("dim").count().where("count > 1").collect():  # one row for each length
        own = distinct.where(F.col("dim") == r["dim"])
        picked = [x["v"] for x in own.orderBy(F.xxhash64("node"), "node").limit(sample).select("v").collect()]
        indexes[r["dim"]] = learn(unit(np.array(picked)), r["count"], threshold, recall)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(2).to_numpy()
            for dim, index in indexes.items():
                part = b.filter(pa.array(dims == dim))
                for at in range(0, part.num_rows, 1024):
                    p = part.slice(at, 1024)
                    keys, weak = index.codes(unit(p.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)))
                    places = np.hstack([_places(keys, dim), _places(keys ^ weak, dim)])
                    lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.reshape(-1))) for z in (keys, weak, places)]
                    yield pa.RecordBatch.from_arrays([p.column(0), *lists], names=["node", "keys", "weak", "places"])

    coded = cut(distinct.select("node", "v", "dim").mapInArrow(codes, "node long, keys array<long>, weak array<long>, places array<long>"))
    places = coded.select("node", F.size("keys").alias("tables"), F.posexplode("places").alias("at", "h")).select("node", "h", (F.col("at") % F.col("tables")).alias("t"), (F.col("at") >= F.col("tables")).alias("probe"))
    crowded = cut(places.groupBy("h").agg(F.count("*").alias("n"), F.count_if(~F.col("probe")).alias("kept")).where("n > 1 AND kept > 0").select("h", "n"))
    tasks = max(1, -(-(crowded.where(f"n <= {BLOCK}").agg(F.sum("n")).first()[0] or 0) // _ROWS))
    blocks = F.when(F.col("n") > BLOCK, F.ceil(F.col("n") / BLOCK)).otherwise(0).cast("int")
    met = join_by_count(places, crowded, "h", "n").select("node", "h", "t", "probe", blocks.alias("blocks"))
    met = met.withColumn("own", F.when(F.col("blocks") > 0, F.pmod(F.xxhash64("node", "t"), F.col("blocks")).cast("int")).otherwise(F.lit(-1)))
    met = met.withColumn("other", F.explode(F.when(F.col("blocks") > 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(-1)))))
    met = met.select("node", "h", "t", "probe", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("blocks") > 0, F.col("h")).otherwise(F.pmod(F.col("h"), F.lit(tasks))).alias("g"))
    full = met.join(coded.select("node", "keys", "weak"), "node").join(distinct.select("node", "weight", "dim", "v"), "node")
    radius = {d: x.radius for d, x in indexes.items()}
    linked = cut(full.groupBy("dim", "g", "i", "j").applyInPandas(lambda g: _compare(g, threshold, radius), "node long, links long, low long"))

    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    found = components(linked.select(F.col("node").alias("a"), F.col("low").alias("b"))).withColumnRenamed("id", "node")
    nodes = distinct.select("node", "weight", "low").join(counts, "node", "left").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lows = nodes.groupBy("component").agg(F.min("low").alias("component_id"))
    nodes = nodes.join(lows, "component").select("node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = ids.join(nodes, "node", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
