"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the one named in ``spark.checkpoint.dir``. Where that is unset, a
    local session gets a temporary folder of its own; a cluster session is an
    error, since a folder of one machine is not seen by the others.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="lodestone-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage, so a lost executor costs its own tasks only, and what is
    used several times is computed once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(run):
    """``run`` for ``mapInArrow``; after each task the worker, which waits for the next one, gives its free memory back.

    Workers outlive their tasks and stages, and else keep the most that any of them took.
    """

    def own(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return own


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns: others may bear names that an operator uses itself."""
    return df.select(*columns)


#: A key of at least 1 / LARGE of all rows, and of at least LEAST rows, is a hot one.
LARGE = 1024
LEAST = 1024


def hot_keys(counted: DataFrame, *keys: str, n: str = "n") -> dict[int, int]:
    """Of ``counted`` (one row a key, ``n`` rows each) the hashes of the hot keys with their parts, powers of two.

    At most LARGE keys hold 1 / LARGE of all rows each, and their parts, as many as make
    none larger than that (or LEAST), number 4 * LARGE at most: a bound at every size.
    """
    total, most = counted.agg(F.sum(n), F.max(n)).first()
    if most is None or most < LEAST or most * LARGE < total:
        return {}
    size = max(LEAST, -(-total // LARGE))
    hot = counted.where(F.col(n) >= size).select(F.xxhash64(*keys).alias("h"), F.col(n).alias("n"))
    return {r["h"]: 1 << (-(-r["n"] // size) - 1).bit_length() for r in hot.collect()}


def spread_join(rows: DataFrame, known: DataFrame, keys: list[str], hot: dict[int, int]) -> DataFrame:
    """Inner join of ``rows`` with ``known`` on ``keys``; ``hot``: :func:`hot_keys` of ``rows``.

    The rows of a hot key are dealt to its parts by a hash of the whole row, and what is
    known of it is copied to each part, so that no task gets all rows of a key. Both
    sides tell hot keys by their hash: one that shares it is dealt likewise.
    """
    if not hot:
        return rows.join(known, keys)
    parts = F.lit(1)
    for count in sorted(set(hot.values())):
        parts = F.when(F.xxhash64(*keys).isin([h for h, p in hot.items() if p == count]), count).otherwise(parts)
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), parts).cast("int"))
    copied = known.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.join(copied, [*keys, "_part"]).drop("_part")


def utf8_bytes(text: Column) -> Column:
    """Length of a text in UTF-8, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def key128(text: Column) -> Column:
    """128-bit key of a text; null has a key of its own."""
    return F.coalesce(F.unhex(F.md5(text)), F.lit(b""))


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]
