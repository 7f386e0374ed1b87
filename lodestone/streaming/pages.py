"""Extension beyond batch: pages that arrive as a stream, kept by key.

The record-linkage batch needs no stream; this keeps a page table fresh for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestone.functions import html, urls

PAGE = "url string, status int, final_url string, text string, fetched timestamp"


def newest_pages(pages: DataFrame) -> DataFrame:
    """One row a cleaned url, the one fetched last, bodies shrunk."""
    clean = pages.select(urls.clean_url(F.col("url")).alias("url"), "status", "final_url", html.shrink_page(F.col("text")).alias("text"), "fetched").where("url <> ''")
    return clean.groupBy("url").agg(F.max_by(F.struct("status", "final_url", "text", "fetched"), "fetched").alias("p")).select("url", "p.*")


def keep_pages(spark: SparkSession, source: str, table: str, checkpoint: str) -> StreamingQuery:
    """Follow a folder of JSON pages; each batch adds a version keyed by its number, so a
    batch that is run again replaces itself. Read with :func:`read_pages`."""

    def write(batch: DataFrame, number: int) -> None:
        newest_pages(batch).write.mode("overwrite").parquet(f"{table}/batch={number}")

    stream = spark.readStream.schema(PAGE).json(source)
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()


def read_pages(spark: SparkSession, table: str) -> DataFrame:
    return newest_pages(spark.read.parquet(table).drop("batch"))
