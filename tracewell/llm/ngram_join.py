"""Exact Jaccard self-join on word shingles with token-combination prefixes.

Shingles are ordered by the number of distinct sets that hold them, rare ones first. Two sets that link must share a shingle among the
first n - ceil(t n) + 1 of each, so shingles that only one set holds are never indexed: of most documents nothing is left to index.
Shingles of the rare class are indexed one by one. For those of the frequent class the prefix is extended by one and pairs of them are
indexed, for two sets that share no rare shingle in their prefixes share two frequent ones in the extended ones.

How it is spread:
- Sets are numbered by a hash of their shingles, so copies of a text are one set, wherever they are.
- Shingles travel in packed, sorted arrays by hash bucket, not as rows; a bucket's task counts them and sends on those held twice.
- First sets that share a band of minima of hashes are compared with one set of the band only, in some turns with another each time,
  and the linked ones are joined to components. An index list whose sets are all in one component is then done with. What is left are pairs across components, found
  through the index; so a group of many near copies costs some comparisons each, not one for each pair, and no link between
  components is lost.
- Before two sets are brought together, bounds rule out most pairs: the places of the shared shingles in the order, the numbers of
  shingles that nobody shares, and the bits in which two parity bitmaps differ, each of which stands for a shingle that only one has.

A shingle is known by 48 bits of a hash where sets are compared, a set by 64.

Defined results: words are runs of bytes other than ASCII white space, A-Z lowered. A text with fewer words than a shingle is one shingle; a
null text or one without words has the empty set, which links with nothing. Rows that repeat an id are rows of their own: each gets the
component of its own text. Null ids count as the largest where one row of a component is chosen. No rows give no rows, further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.spark_util import components, cut, trim, unused

WORDS, PERCENT, FREQUENT = 5, 80, 128
BANDS, BAND_ROWS, STARS = 16, 3, 3
_LARGEST = (1 << 63) - 1
_FLUSH_TOKENS, _FLUSH_SETS = 3_000_000, 60_000
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


_powers = np.ones(1, _U)


def _power(n: int) -> np.ndarray:
    """The first n powers of an odd number; kept for short words."""
    global _powers
    if n > len(_powers):
        new = np.concatenate([np.ones(1, _U), np.full(max(n, 64) - 1, _ODD)])
        new = np.multiply.accumulate(new)
        if n > 4096:
            return new[:n]
        _powers = new
    return _powers[:n]


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, _U)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    raw = np.frombuffer(b"".join(parts), np.uint8).astype(_U) + _U(1)
    starts = np.cumsum(lengths) - lengths
    raw *= _power(int(lengths.max()))[np.arange(len(raw)) - np.repeat(starts, lengths)]
    w = _mix(np.add.reduceat(raw, starts) + lengths.astype(_U))
    if len(w) <= words:
        return _mix(np.bitwise_xor.reduce(_mix(w + np.arange(1, len(w) + 1).astype(_U) * _ODD), keepdims=True) + _U(len(w)))
    n = len(w) - words + 1
    out = np.zeros(n, _U)
    for i in range(words):
        out ^= _mix(w[i : i + n] + _U((i + 1) * int(_ODD) & 0xFFFFFFFFFFFFFFFF))
    return np.unique(_mix(out + _U(words)))


def set_id(tokens: np.ndarray) -> int:
    """A signed 64-bit number for a set."""
    return int((_mix(tokens ^ _ODD).sum(dtype=_U, keepdims=True) + _mix(np.array([len(tokens)], _U))).view(np.int64)[0])


def document_sets(docs: DataFrame, words: int = WORDS, *kept: str) -> DataFrame:
    """(doc_id, n_shingles, node) of each row, and the long columns that are to be kept; node is null for the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, node = [], []
            for t in b.column(1):
                s = shingles(t.as_py(), words)
                n.append(len(s))
                node.append(set_id(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), *b.columns[2:]], names=["doc_id", "n_shingles", "node", *kept])

    return docs.select(F.col("doc_id").cast("long"), "text", *kept).mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "n_shingles", "node", *kept)))


def _packed(docs: DataFrame, bits: int, words: int) -> DataFrame:
    """Rows (bucket, hi, lo, at, nodes, sizes): the shingles of many sets in one hash bucket, sorted. at: the place of the set in nodes."""

    def flush(sets: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not sets:
            return
        sizes = np.array([len(s) for s in sets.values()], np.int32)
        nodes = np.array(list(sets), np.int64)
        packed = np.concatenate(list(sets.values()))
        packed = np.sort(packed >> _U(16) << _U(16) | np.repeat(np.arange(len(sizes)), sizes).astype(_U))
        edges = np.searchsorted(packed, np.arange(1 << bits).astype(_U) << _U(64 - bits)).tolist() + [len(packed)]
        for bucket in range(1 << bits):
            own = packed[edges[bucket] : edges[bucket + 1]]
            if len(own):
                here, at = np.unique(own.astype(np.uint16), return_inverse=True)
                data = [(own >> _U(48)).astype(np.uint16), (own >> _U(16)).astype(np.uint32), at.astype(np.uint16), nodes[here], sizes[here]]
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in data)], names=["bucket", "hi", "lo", "at", "nodes", "sizes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        held = 0
        for b in batches:
            for t in b.column(0):
                s = shingles(t.as_py(), words)
                if len(s) and (node := set_id(s)) not in sets:
                    sets[node] = s
                    held += len(s)
                    if held >= _FLUSH_TOKENS or len(sets) >= _FLUSH_SETS:
                        yield from flush(sets)
                        sets, held = {}, 0
        yield from flush(sets)
        del sets
        trim()

    return docs.select("text").mapInArrow(run, "bucket int, hi binary, lo binary, at binary, nodes binary, sizes binary")


def _shared(group: pd.DataFrame, bits: int) -> pd.DataFrame:
    """Of a bucket, the shingles that two or more sets hold, packed by the sets' own buckets."""
    nodes, sizes, toks, ats, base = [], [], [], [], 0
    for r in group.itertuples():
        n = np.frombuffer(r.nodes, np.int64)
        toks.append(np.frombuffer(r.hi, np.uint16).astype(_U) << _U(32) | np.frombuffer(r.lo, np.uint32).astype(_U))
        ats.append(np.frombuffer(r.at, np.uint16).astype(np.int64) + base)
        nodes.append(n)
        sizes.append(np.frombuffer(r.sizes, np.int32))
        base += len(n)
    node, size, tok, at = map(np.concatenate, (nodes, sizes, toks, ats))
    _, first, where = np.unique(node, return_index=True, return_inverse=True)
    kept = first[where[at]] == at  # a set that came from several tasks counts once
    tok, at = tok[kept], at[kept]
    order = np.argsort(tok, kind="stable")
    tok, at = tok[order], at[order]
    edge = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1], [True]]))
    df = np.repeat(np.diff(edge), np.diff(edge))
    tok, at, df = tok[df > 1], at[df > 1], df[df > 1]
    own = (_mix(node.view(_U)) >> _U(64 - bits)).astype(np.int64)[at]
    order = np.argsort(own, kind="stable")
    tok, at, df, own = tok[order], at[order], df[order], own[order]
    out = []
    for b, start, n in zip(*np.unique(own, return_index=True, return_counts=True)):
        part = slice(start, start + n)
        here, place = np.unique(at[part], return_inverse=True)
        out.append((int(b), (tok[part] >> _U(32)).astype(np.uint16).tobytes(), tok[part].astype(np.uint32).tobytes(), place.astype(np.uint32).tobytes(), df[part].astype(np.uint32).tobytes(), node[here].tobytes(), size[here].tobytes()))
    return pd.DataFrame(out, columns=["own", "hi", "lo", "at", "df", "nodes", "sizes"])


_SHARED = "own int, hi binary, lo binary, at binary, df binary, nodes binary, sizes binary"
_INDEXED = "node long, n int, alone int, s0 long, s1 long, s2 long, s3 long, bands array<long>, shared binary, prefix binary, df binary, single int"
_BOUNDS = ["node", "n", "alone", "s0", "s1", "s2", "s3"]


def _parity(tokens: np.ndarray) -> list[int]:
    """256 bits; each token turns one of them."""
    bits = np.bincount((_mix(tokens.view(_U)) >> _U(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()


_SEEDS = _mix(np.arange(1, BANDS * BAND_ROWS + 1).astype(_U))


def _bands(tokens: np.ndarray) -> list[int]:
    low = np.array([_mix(tokens.view(_U) ^ s).min() for s in _SEEDS]).reshape(BANDS, BAND_ROWS)
    return _mix(_mix(low[:, 0] + np.arange(BANDS).astype(_U)) ^ _mix(low[:, 1]) * _ODD ^ _mix(low[:, 2] + _ODD)).view(np.int64).tolist()


def _may_link(percent: int) -> str:
    """SQL: the bounds don't rule out that sets a and b link."""
    need = f"((n_a + n_b) * {percent} + {99 + percent}) div {100 + percent}"
    differ = " + ".join(f"bit_count(s{i}_a ^ s{i}_b)" for i in range(4))
    return f"{differ} + alone_a + alone_b <= n_a + n_b - 2 * ({need})"


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """So many shingles, first in the common order, of a set of n: another that links shares one of them."""
    return n - -(-percent * n // 100) + 1


def _prefixes(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """For each set whose prefix has shared shingles: all of its shared ones, and those of the prefix extended by one with their counts."""
    nodes, sizes, toks, ats, dfs, base = [], [], [], [], [], 0
    for r in group.itertuples():
        toks.append(np.frombuffer(r.hi, np.uint16).astype(np.int64) << 32 | np.frombuffer(r.lo, np.uint32).astype(np.int64))
        ats.append(np.frombuffer(r.at, np.uint32).astype(np.int64) + base)
        dfs.append(np.frombuffer(r.df, np.uint32).astype(np.int64))
        nodes.append(np.frombuffer(r.nodes, np.int64))
        sizes.append(np.frombuffer(r.sizes, np.int32))
        base += len(nodes[-1])
    node, size, tok, at, df = map(np.concatenate, (nodes, sizes, toks, ats, dfs))
    ids, first, where = np.unique(node, return_index=True, return_inverse=True)
    own = where[at]
    order = np.lexsort((tok, df, own))
    tok, df, own = tok[order], df[order], own[order]
    edges = np.searchsorted(own, np.arange(len(ids) + 1))
    out = []
    for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        n = int(size[first[i]])
        single = prefix_length(n, percent) - (n - (b - a))
        if single > 0:
            part = slice(a, min(b, a + single + 1))
            shared = np.sort(tok[a:b])
            out.append((int(ids[i]), n, n - (b - a), *_parity(shared), _bands(shared), shared.tobytes(), tok[part].tobytes(), df[part].tobytes(), single))
    return pd.DataFrame(out, columns=["node", "n", "alone", "s0", "s1", "s2", "s3", "bands", "shared", "prefix", "df", "single"])


def _entries(indexed: DataFrame) -> DataFrame:
    """(token, df, node, place, single): a row for each shingle of the extended prefixes. place: its number in the set's order; single: it is in the prefix itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            toks = [np.frombuffer(x.as_py(), np.int64) for x in b.column(2)]
            count = np.array([len(t) for t in toks])
            place = np.concatenate([np.arange(c) for c in count])
            single = place < np.repeat(b.column(4).to_numpy(), count)
            place = (place + np.repeat(b.column(1).to_numpy(), count)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(toks)), pa.array(np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in b.column(3)])), pa.array(np.repeat(b.column(0).to_numpy(), count)), pa.array(place), pa.array(single)], names=["token", "df", "node", "place", "single"])

    return indexed.select("node", "alone", "prefix", "df", "single").mapInArrow(run, "token long, df long, node long, place int, single boolean")


def _verified(pairs: DataFrame, indexed: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that reach the similarity."""
    side = lambda c: indexed.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("shared").alias(f"s_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, sa, nb, sb = batch.columns
            keep = []
            for x, y, n, m in zip(sa, sb, na.to_pylist(), nb.to_pylist()):
                both = len(np.intersect1d(np.frombuffer(x.as_py(), np.int64), np.frombuffer(y.as_py(), np.int64)))
                keep.append(100 * both >= percent * (n + m - both))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "s_a", "n_b", "s_b")
    return joined.mapInArrow(run, "a long, b long")


def links(docs: DataFrame, n_rows: int, words: int = WORDS, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """(a, b): pairs of sets that are linked, or joined by links already found; together they connect all sets that any links connect. n_rows: rows of docs, for the number of buckets."""
    bits = min(20, max(6, math.ceil(math.log2(max(1, n_rows) / 4000))))
    shared = _packed(docs, bits, words).groupBy("bucket").applyInPandas(lambda g: _shared(g, bits), _SHARED)
    indexed = cut(shared.groupBy("own").applyInPandas(lambda g: _prefixes(g, percent), _INDEXED))
    entries = cut(_entries(indexed))

    bounds = indexed.select(*[F.col(x).alias(x if x == "node" else f"{x}_a") for x in _BOUNDS])
    banded = cut(indexed.select(F.explode("bands").alias("band"), *_BOUNDS))
    known = None
    for turn in range(STARS):  # each with other sets as the bands' centres
        placed = banded.withColumn("component", F.col("node")) if known is None else banded.join(known.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
        names = [*_BOUNDS, "component"]
        centres = placed.groupBy("band").agg(F.min_by(F.struct(*names), F.xxhash64(F.lit(turn), "band", "node") if turn else F.col("node")).alias("y"), F.count("*").alias("c")).where("c > 1")
        sides = [[F.col(n).alias(s if n == "node" else f"{n}_{s}") for n in names] for s in "ab"]
        stars = placed.join(centres, "band").where("component <> y.component").select(*sides[0], *[F.col(f"y.{n}").alias("b" if n == "node" else f"{n}_b") for n in names])
        found = cut(_verified(stars.where(_may_link(percent)).select("a", "b").distinct(), indexed, percent))
        known = components(found if known is None else found.unionByName(known.select(F.col("id").alias("a"), F.col("component").alias("b"))))

    placed = cut(entries.join(known.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node")))
    open_ = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
    live = cut(placed.join(open_, "token").join(bounds.withColumnRenamed("a", "node"), "node"))
    rest = ["node", "component", *[f"{x}_a" for x in _BOUNDS[1:]]]
    single = live.where(f"single AND df <= {frequent}").select(F.col("token").alias("key"), F.lit(0).cast("long").alias("key2"), "place", *rest)
    often = live.where(f"df > {frequent}").groupBy(*rest).agg(F.sort_array(F.collect_list(F.struct("place", "token", "single"))).alias("t"))
    two = often.select(*rest, "t", F.posexplode("t").alias("i", "x")).where("x.single").select(F.col("x.token").alias("key"), F.explode(F.expr("slice(t, i + 2, size(t))")).alias("y"), *rest)
    two = two.select("key", F.col("y.token").alias("key2"), (F.col("y.place") - 1).alias("place"), *rest)
    left = single.unionByName(two).withColumnsRenamed({"node": "a", "component": "c_a", "place": "p_a"})
    right = left.withColumnsRenamed({"a": "b", **{c: c[:-1] + "b" for c in left.columns if c.endswith("_a")}})
    reach = f"{100 + percent} * least(n_a - p_a, n_b - p_b) >= {percent} * (n_a + n_b)"  # what can still be shared from here on
    pairs = left.join(right, ["key", "key2"]).where(f"a < b AND c_a <> c_b AND {reach} AND {_may_link(percent)}").select("a", "b").distinct()
    return known.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(_verified(pairs, indexed, percent))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id): the size of each row's set, the smallest id that is reachable by links, and a number of its distinct set."""
    rows = cut(document_sets(docs, words))
    found = components(cut(links(docs, rows.count(), words, percent, frequent))).select(F.col("id").alias("node"), "component")
    sets = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("low"))
    sets = sets.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    low = sets.groupBy("component").agg(F.min("low").alias("component_id"))
    sets = sets.join(low, "component").select("node", "component_id")
    return rows.join(sets, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.col("node").alias("class_id"))


def without_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """All columns of docs, and of each component's rows only one: that with the smallest id, and of these the one with the smallest hash of its text.

    Rows without shingles stay. What goes is known by (id, hash of the text), so rows that share an id are told apart; of rows that are the same in
    both, one stays.
    """
    row, content = (unused(n, docs.columns) for n in ("_row", "_content"))
    keyed = docs.select("text", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LARGEST)).alias("doc_id"), F.xxhash64("text").alias("content"))
    rows = cut(document_sets(keyed, words, "content"))
    found = components(cut(links(docs, rows.count(), words, percent, frequent))).select(F.col("id").alias("node"), "component")
    places = rows.where("node IS NOT NULL").groupBy("node", "doc_id", "content").agg(F.count("*").alias("copies"))
    places = places.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    places = cut(places.select("component", "doc_id", "content", "copies"))
    best = places.groupBy("component").agg(F.min(F.struct("doc_id", "content")).alias("best"))
    marked = places.join(best, "component").withColumn("kept", (F.col("best.doc_id") == F.col("doc_id")) & (F.col("best.content") == F.col("content")))
    marked = cut(marked.where("NOT kept OR copies > 1").select(F.col("doc_id").alias(row), F.col("content").alias(content), "kept"))
    given = docs.withColumns({row: F.coalesce(F.col("doc_id").cast("long"), F.lit(_LARGEST)), content: F.xxhash64("text")})
    out = given.join(marked.drop("kept"), [row, content], "left_anti")
    again = marked.where("kept").drop("kept")
    if not again.isEmpty():  # kept rows that are there more than once
        out = out.unionByName(given.join(again, [row, content], "left_semi").dropDuplicates([row, content]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
