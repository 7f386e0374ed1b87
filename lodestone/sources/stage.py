"""Steps of a plan that are written to the shared folder and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written as Parquet and read again: computed once, planned once, and safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, rank: str, *order: Column | str) -> DataFrame:
    """``df`` with ``rank``, 1 upwards in the given order over all rows.

    A range sort with a number for each row of a partition, and the partitions'
    sizes added up: no task holds all rows. The sizes are one row a partition.
    """
    at = F.monotonically_increasing_id()
    low = F.lit((1 << 33) - 1)
    placed = staged(df.orderBy(*order).withColumn("_at", at), "ranked").withColumn("_part", F.shiftright("_at", 33))
    sizes = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    before, starts = 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _before long")
    return placed.join(F.broadcast(offsets), "_part").withColumn(rank, (F.col("_before") + F.col("_at").bitwiseAND(low) + 1).cast("int")).drop("_part", "_before", "_at")
