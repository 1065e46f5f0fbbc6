"""Hashed sparse vectors of texts, and the hybrid of keyword and vector search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DIMENSIONS = 256
_SEPARATORS = str.maketrans("", "", "_-.")
#: Weights of features in twentieths, by the length of their letters; 0: whole tokens.
_PARTS, _NAMES = {0: 20, 3: 6, 4: 9}, {0: "tok:", 3: "tri:", 4: "quad:"}

#: Tokens, and parts of tokens, whose hashes a worker keeps; rows and tokens that it counts at a time, and its rows' different tokens.
KEPT, ROWS, TOKENS, PAIRS = 200_000, 512, 400_000, 100_000


def _number(feature: str, family: str) -> int:
    """32 bits of a feature's hash."""
    raw = feature.encode()
    return int(hashlib.md5(raw).hexdigest()[:8], 16) if family == "md5" else int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "big") & 0xFFFFFFFF


class _Parts(dict):
    """A feature as one number, by its three or four letters: 64 times its bucket, and its signed weight with 32 added."""

    def __init__(self, dimensions: int, family: str) -> None:
        self.dimensions, self.family = dimensions, family

    def made(self, text: str, size: int) -> int:
        n = _number(_NAMES[size] + text, self.family)
        return 64 * (n % self.dimensions) + 32 + (_PARTS[size] if n % 2 else -_PARTS[size])

    def __missing__(self, text: str) -> int:
        got = self.made(text, len(text))
        if len(self) < KEPT:
            self[text] = got
        return got


class _Tokens(dict):
    """The features of a token, each as one number of _Parts."""

    def __init__(self, dimensions: int, family: str) -> None:
        self.parts = _Parts(dimensions, family)

    def __missing__(self, token: str) -> np.ndarray:
        plain, parts = token.translate(_SEPARATORS), self.parts
        made = [parts.made(token, 0)]
        if len(plain) >= 5:
            made += [parts[plain[i : i + 3]] for i in range(len(plain) - 2)]
        if len(plain) >= 7:
            made += [parts[plain[i : i + 4]] for i in range(len(plain) - 3)]
        got = np.array(made, np.int32 if parts.dimensions < 1 << 25 else np.int64)
        if len(self) < KEPT:
            self[token] = got
        return got


@cache
def _hashed(dimensions: int, family: str) -> _Tokens:
    """What a worker keeps from one task to the next."""
    return _Tokens(dimensions, family)


def _sums(lists: pa.ListArray, dimensions: int, family: str) -> np.ndarray:
    """Of each list of tokens the sums of its features' weights by bucket, in twentieths: whole numbers, so weights of 1, 0.3 and 0.45 cancel out."""
    sums = np.zeros(len(lists) * dimensions)
    coded = lists.flatten().dictionary_encode()
    if not len(coded):
        return sums.reshape(len(lists), dimensions)
    row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    hashed, tokens = _hashed(dimensions, family), coded.dictionary.to_pylist()
    features = [hashed[t] for t in tokens]
    size = np.fromiter(map(len, features), np.int64, len(features))
    first, flat = np.cumsum(size) - size, np.concatenate(features)
    pairs, times = np.unique(row * len(tokens) + coded.indices.to_numpy(), return_counts=True)
    for at in range(0, len(pairs), PAIRS):
        row, token = np.divmod(pairs[at : at + PAIRS], len(tokens))
        n = size[token]
        found = flat[np.repeat(first[token] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        sums += np.bincount(np.repeat(row * dimensions, n) + found // 64, (found % 64 - 32) * np.repeat(times[at : at + PAIRS], n), len(sums))
    return sums.reshape(len(lists), dimensions)


def _rounded(w: np.ndarray) -> np.ndarray:
    """To 6 places, halves of the decimal figure away from zero, as round() does."""
    scaled = np.abs(w) * 1e6
    out = np.copysign(np.floor(scaled + 0.5) / 1e6, w)
    for i in np.argwhere(np.abs(scaled % 1 - 0.5) < 1e-6):  # the product may be on the other side
        out[*i] = float(Decimal(repr(float(w[*i]))).quantize(Decimal("0.000001"), ROUND_HALF_UP))
    return out


def _weights(batches: Iterator[pa.RecordBatch], column: int, dimensions: int, family: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Some rows at a time: those, and the unit vectors of the tokens in one of their columns, rounded to 6 places."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(b.column(column)), 0).to_numpy())
        at = 0
        while at < b.num_rows:
            most = np.searchsorted(ends, (ends[at - 1] if at else 0) + TOKENS, "right")
            part = b.slice(at, max(1, min(int(most) - at, ROWS)))
            at += part.num_rows
            w = _sums(part.column(column), dimensions, family) / 20
            norm = np.sqrt((w * w).sum(axis=1, keepdims=True))
            yield part, _rounded(w / np.where(norm > 0, norm, 1.0))


def vectors(rows: DataFrame, key: str, tokens: str = "tokens", dimensions: int = DIMENSIONS, family: str = "md5") -> DataFrame:
    """(key, bucket, w): the sparse unit vector of each row's tokens, weights rounded to 6 places.

    A feature's bucket and sign come from a hash number's remainder and lowest bit; family is 'md5' or 'blake2b'. Only the lowest 32 bits of the
    latter are kept, which is the same for dimensions that are powers of two. All features of a row are in it, so nothing is shuffled:
    an Arrow function sums them for some hundred rows at once, with the hashes of many tokens at hand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, w in _weights(batches, 1, dimensions, family):
            row, bucket = np.nonzero(w)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(bucket.astype(np.int32)), pa.array(w[row, bucket])], names=["key", "bucket", "w"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("key"), F.col(tokens)).mapInArrow(run, f"key {kind}, bucket int, w double")


def search_tokens(docs: DataFrame, analysed: DataFrame, k: int = 5, dimensions: int = DIMENSIONS, family: str = "md5") -> DataFrame:
    """search over the vectors of docs(key, ord, tokens) that aren't stored: each is multiplied with all queries' where it is made, and only its products leave the worker.

    The queries, some rows, are gathered: a matrix of their number times the dimensions.
    """
    asked = vectors(analysed, "query_id", "terms", dimensions, family).collect()
    names = sorted({r["key"] for r in asked})
    matrix = np.zeros((dimensions, len(names)))
    for r in asked:
        matrix[r["bucket"], names.index(r["key"])] = r["w"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, w in _weights(batches, 2, dimensions, family):
            dots = w @ matrix
            row, query = np.nonzero(dots > 0)
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.array(names, object)[query], pa.string()), b.column(0).take(row), b.column(1).take(row), pa.array(dots[row, query])], names=["query_id", "key", "ord", "dot"])

    kinds = {c: docs.schema[c].dataType.simpleString() for c in ("key", "ord")}
    dots = docs.select("key", "ord", "tokens").mapInArrow(run, f"query_id string, key {kinds['key']}, ord {kinds['ord']}, dot double").withColumn("dot", F.round("dot", 9)).where("dot > 0")
    ranked = dots.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.col("dot").desc(), "ord")))
    return ranked.where(F.col("rank") <= k).select("query_id", "key", F.round("dot", 6).alias("score"), "rank")


def search(stored: DataFrame, docs: DataFrame, analysed: DataFrame, k: int = 5, **hashing) -> DataFrame:
    """(query_id, key, score, rank): the k best rows of each query by dot product, only positive ones; docs has key and ord."""
    q = vectors(analysed, "query_id", "terms", **hashing).select(F.col("key").alias("query_id"), "bucket", F.col("w").alias("qw"))
    dots = stored.join(F.broadcast(q), "bucket").groupBy("query_id", "key").agg(F.round(F.sum(F.col("qw") * F.col("w")), 9).alias("dot")).where("dot > 0")
    ranked = dots.join(docs.select("key", "ord"), "key").withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.col("dot").desc(), "ord")))
    return ranked.where(F.col("rank") <= k).select("query_id", "key", F.round("dot", 6).alias("score"), "rank")


def hybrid(keyword: DataFrame, vector: DataFrame, k: int = 5, graph: str | None = None) -> DataFrame:
    """Full join of the two arms' ranked candidates, scored by .65 keyword + .35 vector (+ .85 graph), each by its largest value."""
    left = keyword.select("query_id", "key", F.col("score").alias("keyword_raw"), F.col("rank").alias("keyword_rank"), (F.col(graph) if graph else F.lit(0.0)).alias("graph_raw"))
    right = vector.select("query_id", "key", F.col("score").alias("vector_raw"), F.col("rank").alias("vector_rank"))
    both = left.join(right, ["query_id", "key"], "full").fillna(0.0, ["keyword_raw", "vector_raw", "graph_raw"])
    top = W.partitionBy("query_id")
    part = lambda c: F.coalesce(F.col(c) / F.nullif(F.max(c).over(top), F.lit(0.0)), F.lit(0.0))
    both = both.withColumns({"keyword_normalized": part("keyword_raw"), "vector_normalized": part("vector_raw"), "graph_normalized": part("graph_raw")})
    both = both.withColumn("score", F.round(0.65 * F.col("keyword_normalized") + 0.35 * F.col("vector_normalized") + 0.85 * F.col("graph_normalized"), 6))
    far = F.lit(999999)
    order = top.orderBy(F.col("score").desc(), F.round("graph_normalized", 6).desc(), F.coalesce("keyword_rank", far), F.coalesce("vector_rank", far), F.col("keyword_raw").desc(), F.col("vector_raw").desc(), "key")
    out = both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.withColumns({c: F.round(c, 6) for c in ("keyword_normalized", "vector_normalized", "graph_normalized")})
