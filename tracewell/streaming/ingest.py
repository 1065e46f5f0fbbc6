"""Streaming ingest of pages: repeated captures are dropped under a watermark, and each micro-batch is written as posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tracewell.sources.pages import texts, title


def read_pages(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def distinct_captures(pages: DataFrame, clock: str = "captured_at", delay: str = "1 hour") -> DataFrame:
    """Drops captures of an address whose content was seen within the delay."""
    return pages.withColumn("sha256", F.sha2("html", 256)).withWatermark(clock, delay).dropDuplicatesWithinWatermark(["url", "sha256"])


def write_posts(pages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Each batch goes to a folder of its own number, so that a repeated batch overwrites itself."""

    def batch(rows: DataFrame, number: int) -> None:
        with_title = rows.select(F.struct("page_id", "url", title(F.col("html")).alias("title")).alias("page"), "html")
        texts(with_title, "page").select("page.*", "text").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
