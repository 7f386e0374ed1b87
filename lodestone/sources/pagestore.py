"""Stored pages: keys, writing and reading by key, decoding of bodies, robots rules."""

from __future__ import annotations

import gzip
import zlib
from functools import lru_cache
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import html, urls

PAGE = "url string, status int, final_url string, text string, error string"
# Fixed value: how a robots file begins; anything else is a page in its place.
ROBOTS_START = r"(?is)^\s*(?:user-agent|#|sitemap|allow|disallow|crawl)"


def store_key(url: Column) -> Column:
    """Digest that a stored page is filed under."""
    return F.sha1(url)


def write_pages(pages: DataFrame, path: str) -> None:
    """Append shrunk pages, filed by the first two digits of their key, so that lookups prune folders."""
    kept = pages.select("url", "status", "final_url", html.shrink_page(F.col("text")).alias("text"), F.coalesce("error", F.lit("")).alias("error") if "error" in pages.columns else F.lit("").alias("error"))
    keyed = kept.withColumn("key", store_key(F.col("url"))).withColumn("at", F.current_timestamp())
    keyed.withColumn("shelf", F.substring("key", 1, 2)).write.mode("append").partitionBy("shelf").parquet(path)


def read_pages(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """Stored pages, of each url the one written last; with ``wanted (url)`` only theirs."""
    stored = spark.read.parquet(path)
    if wanted is not None:
        keys = wanted.select(store_key(F.col("url")).alias("key")).distinct().withColumn("shelf", F.substring("key", 1, 2))
        stored = stored.withColumn("shelf", F.col("shelf").cast("string")).join(keys, ["shelf", "key"], "left_semi")
    row = F.struct("url", "status", "final_url", "text", "error")
    return stored.groupBy("key").agg(F.max_by(row, F.struct("at", row)).alias("r")).select("r.*")


def decode_body(raw: bytes | None, encoding: str | None, content_type: str | None) -> str | None:
    """Text of a response: unpacked if it says or looks so, in the stated charset, else UTF-8, else Latin-1."""
    if raw is None:
        return None
    packing = (encoding or "").lower()
    try:
        if "gzip" in packing or raw.startswith(b"\x1f\x8b"):
            raw = gzip.decompress(raw)
        elif "deflate" in packing:
            raw = zlib.decompress(raw, -zlib.MAX_WBITS)
    except (OSError, EOFError, zlib.error):
        pass  # Not packed after all: read as it is.
    stated = (content_type or "").partition("charset=")[2].partition(";")[0].strip()
    for charset in filter(None, (stated, "utf-8")):
        try:
            return raw.decode(charset)
        except (UnicodeDecodeError, LookupError):
            continue
    return raw.decode("latin-1")


def decoded(responses: DataFrame, body: str = "body", encoding: str = "content_encoding", content_type: str = "content_type", out: str = "text") -> DataFrame:
    """``responses`` with the text of each body in place of its bytes."""

    @F.pandas_udf("string")
    def text(raw: pd.Series, packing: pd.Series, kind: pd.Series) -> pd.Series:
        return pd.Series([decode_body(*one) for one in zip(raw, packing, kind, strict=True)], dtype=object)

    return responses.withColumn(out, text(body, encoding, content_type)).drop(body)


@lru_cache(1024)
def parsed_rules(rules: str) -> RobotFileParser:
    parser = RobotFileParser()
    parser.parse(rules.splitlines())
    return parser


def allowed_by_robots(wanted: DataFrame, robots: DataFrame, agent: str) -> DataFrame:
    """``wanted (url, ...)`` with ``allowed``: what the host's robots file says to ``agent``.

    ``robots``: url, status, text of stored robots files. A host without one, or with a
    page in its place, allows all. A file is parsed once a worker, however many urls.
    """
    host = lambda c: F.lower(urls.netloc_of(F.col(c)))
    rules = robots.where((F.col("status") == 200) & F.col("text").rlike(ROBOTS_START)).groupBy(host("url").alias("_host")).agg(F.min("text").alias("_rules"))

    @F.pandas_udf("boolean")
    def may(url: pd.Series, rules_: pd.Series) -> pd.Series:
        return pd.Series([not isinstance(r, str) or parsed_rules(r).can_fetch(agent, u) for u, r in zip(url, rules_, strict=True)])

    return wanted.withColumn("_host", host("url")).join(rules, "_host", "left").withColumn("allowed", may("url", "_rules")).drop("_host", "_rules")
