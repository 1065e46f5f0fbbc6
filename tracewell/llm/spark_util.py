"""Small helpers of this subpackage: durable cuts of lineage, and linked components."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """Writes the rows to the session's checkpoint folder, which all executors share, and goes on from there.

    The folder is the one in spark.checkpoint.dir. Only where that is unset and the session runs on this machine alone is one made; a cluster
    without it is an error.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)


def unused(name: str, columns: Sequence[str]) -> str:
    """The name, with as many underscores before it as keep it apart from the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def join_by_count(left: DataFrame, right: DataFrame, key: str, count: str, share: int = 500, least: int = 256) -> DataFrame:
    """Inner join on a key of which right has one row with the number of left's rows, or less, in a column.

    Keys with more than 1/share of left's rows are at most `share`; their rows stay where they are and right's are broadcast. The others are
    shuffled. Both sides should be cut, for they are read twice.
    """
    limit = max(least, left.count() // share)
    hot = [r[0] for r in right.where(F.col(count) > limit).select(key).collect()]
    return _split_join(left, right, key, hot)


def trim() -> None:
    """Gives what was freed back to the machine, where its C library can: Python workers go on after a stage, and others need the room."""
    pa.default_memory_pool().release_unused()
    if (give_back := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        give_back(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _split_join(left: DataFrame, right: DataFrame, key: str, hot: list) -> DataFrame:
    """Inner join where the left rows of some keys, of which right has one row each, stay where they are."""
    if not hot:
        return left.join(right, key)
    is_hot = F.col(key).isin(hot)
    return left.where(is_hot).join(F.broadcast(right.where(is_hot)), key).unionByName(left.where(~is_hot).join(right.where(~is_hot), key))


def _state(pairs: DataFrame, share: int = 500, least: int = 256) -> tuple[bool, list]:
    """Whether the edges form stars, so that nothing is left to link; and (id, smallest neighbour) of the ids in more than 1/share of them, at most 2 * share."""
    limit = max(least, pairs.count() // share)
    ends = pairs.select(F.col("u").alias("id"), F.col("v").alias("o"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(pairs.select(F.col("v").alias("id"), F.col("u").alias("o"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ids = ends.groupBy("id").agg(F.sum("up").alias("up"), F.sum("down").alias("down"), F.min("o").alias("m"))
    # Each u of a star has one v, and no id is a u and a v.
    got = ids.agg(F.bool_or(F.expr("up > 0 AND up + least(down, 1) > 1")), F.collect_list(F.when(F.col("up") + F.col("down") > limit, F.struct("id", F.least("id", "m").alias("m"))))).first()
    return not got[0], [tuple(r) for r in got[1]]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id that can be reached over the edges, for each id in them.

    Rounds of large-star and small-star linking, as DataFrame aggregations and joins: each round links the neighbours of every id
    to the smallest of them, so that chains halve and a hub with many neighbours is only ever a key with a minimum (partial sums
    come before the shuffle, and the edges of hubs aren't shuffled for the joins). Rounds end when all edges form stars, so edges
    that were components before cost one test. No edges give no rows.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    pairs = cut(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        done, hubs = _state(pairs)
        if done:
            break
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        if hubs:  # their edges aren't shuffled by them
            is_hub = F.col("u").isin([u for u, _ in hubs])
            known = F.broadcast(pairs.sparkSession.createDataFrame(hubs, "u long, m long"))
            near = both.where(is_hub).join(known, "u").unionByName(both.where(~is_hub).join(low, "u"))
        else:
            near = both.join(low, "u")
        large = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        pairs = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    roots = pairs.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
