"""Cuts between stages: results that several later steps read are written once to the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to spark.checkpoint.dir and read from there by every later step."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is worked out once for each row: the optimizer copies columns into the expressions that use them, but not what a generator gives."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table with fewer parts than the session has cores, dealt out to all of them; larger tables stay as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
