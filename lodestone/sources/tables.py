"""Readers and writers of the record-linkage tables."""

from __future__ import annotations

import functools
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.names import strip

# The columns of the two sheets and of the results.
LEGACY_COLUMNS = ("id", "name", "institution_name", "course_url", "Notes", "course_url_via_web_search", "matched_score", "matched_status", "website")
RESULT_COLUMNS = LEGACY_COLUMNS + ("match_margin", "live_page_score", "match_evidence", "row_flags", "prior_course_url", "prior_matched_status", "url_change")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A quoted CSV as strings; byte-order mark and blank lines dropped, fields trimmed, null as ''."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False, encoding="UTF-8")
    named = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    clean = named.select(*[strip(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in named.columns])
    return clean.where(F.concat_ws("", *[F.col(f"`{c}`") for c in clean.columns]) != "")


#: A field after its comma: quoted, up to the closing quote or the line's end, or plain.
_FIELD = r',("[^"]*+(?:""[^"]*+)*+(?:"[^,]*+|$)|[^,]*+)'
_QUOTED = r'^"([^"]*+(?:""[^"]*+)*+)"?(.*)$'


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A ragged CSV as ``(ord, fields array<string>)``, the header included, every field of every line.

    A record is a line; a quote that stays open takes the rest of its line.
    Lines without any text are dropped. ``ord`` rises in file order; it is exact
    for one file that is read whole.
    """
    plain = lambda x: F.concat(F.replace(F.regexp_extract(x, _QUOTED, 1), F.lit('""'), F.lit('"')), F.regexp_extract(x, _QUOTED, 2))
    found = F.regexp_extract_all(F.concat(F.lit(","), F.regexp_replace("value", "^\ufeff", "")), F.lit(_FIELD), F.lit(1))
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), F.transform(found, lambda x: F.when(x.startswith('"'), plain(x)).otherwise(x)).alias("fields"))
    return lines.where(F.exists("fields", lambda x: strip(x) != ""))


def read_keyed(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """A CSV by key; of rows with equal keys the last one counts."""
    df = read_csv(spark, path).withColumn("_ord", F.monotonically_increasing_id())
    others = [c for c in df.columns if c not in (key, "_ord")]
    last = df.groupBy(key).agg(F.max_by(F.struct(*others), "_ord").alias("r")) if others else df.select(key).distinct()
    return last.select(key, "r.*") if others else last


def union_chunks(parts: list[DataFrame]) -> DataFrame:
    """All rows of parts with one header; another header is an error."""
    header = parts[0].columns
    for k, part in enumerate(parts):
        if part.columns != header:
            raise ValueError(f"part {k} has other columns: {part.columns} instead of {header}")
    return functools.reduce(DataFrame.unionByName, parts)


def read_json_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines (gzip too) with a stated schema; corrupt records become nulls, missing fields too."""
    return spark.read.json(path, schema=schema, mode="PERMISSIVE")


def read_catalogs(spark: SparkSession, path: str, least_version: int = 3) -> DataFrame:
    """Cached catalogues whose schema is recent enough to be used again."""
    return spark.read.option("mergeSchema", "true").parquet(path).where(F.col("schema_version") >= least_version)


def write_csv(df: DataFrame, path: str, order: list | None = None) -> None:
    """One file with header; rows sorted by ``order``. For deliverables, not for large tables."""
    out = df.coalesce(1)
    (out.sortWithinPartitions(*order) if order else out).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def write_chunks(df: DataFrame, path: str, chunk: str = "chunk") -> None:
    df.repartition(chunk).write.mode("overwrite").partitionBy(chunk).csv(path, header=True, escape='"', emptyValue="")


def manifest(chunks: DataFrame, source_rows: int, no_website_rows: int) -> str:
    """JSON manifest of ``(chunk, site, rows)``; the site list is small, one row a site."""
    found = chunks.groupBy("chunk").agg(F.count("*").alias("sites"), F.sum("rows").alias("rows"), F.array_sort(F.collect_set("site")).alias("hosts")).orderBy("chunk")
    return json.dumps({"source_rows": source_rows, "no_website_rows": no_website_rows, "chunks": [r.asDict() for r in found.collect()]}, indent=1)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows whose key ``new`` lacks, and all of ``new``: insert or replace by primary key."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
