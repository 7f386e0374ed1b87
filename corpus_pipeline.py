"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, decontaminate, linededup, minhash, quality
from lodestone.llm.common import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules reject go; the others lose their failing lines.

    Each row is judged by itself, whatever its id; a null or blank text is rejected.
    """
    judged = quality.clean_and_judge(docs, passthrough=True).where("kept")
    return _documents(judged.drop("text").withColumnRenamed("clean_text", "text"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds go; so do documents that held nothing else.

    Rows with a null id, and null and blank texts, are left alone; rows equal in id and
    text get equal answers.
    """
    return _documents(linededup.remove_shared_passages(docs).where("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (5-word shingles, similarity 0.8).

    That is the one with the smallest id, null the largest. Each pair of id and text is
    a document of its own: rows that share an id, or have none, go only if their text is
    linked to another's that stays; of rows equal in id and text one stays. Null and
    blank texts are linked with nothing.
    """
    shared = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    if shared.isEmpty():
        kept = minhash.near_duplicates(docs, shingle_words=5, percent=80).where("kept").select("doc_id")
        return _documents(docs.join(kept, "doc_id", "left_semi"))
    # Ids that tell nothing apart: documents are numbered in the order of id and text.
    keyed = docs.withColumn("h", F.sha2("text", 256))
    numbered = keyed.select("doc_id", "h").distinct().orderBy(F.col("doc_id").asc_nulls_last(), "h").withColumn("nr", F.monotonically_increasing_id())
    numbered = materialise(numbered, "numbered")
    n = numbered.select(F.col("doc_id").alias("i"), F.col("h").alias("t"), "nr")
    rows = keyed.join(n, F.col("doc_id").eqNullSafe(F.col("i")) & F.col("h").eqNullSafe(F.col("t"))).select(*COLUMNS, "nr")
    single = materialise(rows.groupBy("nr").agg(F.min(F.struct(*COLUMNS)).alias("d")).select("nr", "d.*"), "single")
    kept = minhash.near_duplicates(single, "nr", shingle_words=5, percent=80).where("kept").select(F.col("doc_id").alias("nr"))
    return _documents(single.join(kept, "nr", "left_semi"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Each row is judged by itself, whatever its id; null and blank texts hold none, and
    without a benchmark all stay.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, benchmark, [c for c in COLUMNS if c != "text"], with_text=True)
    # Without a hit the text comes back as it was.
    return _documents(found.where(F.size("ranges") == 0).withColumnRenamed("clean_text", "text"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text again.

    One row for each, whatever its id; a null text counts as empty and decodes to that.
    """
    path = public_tokenizers.path("byte_bpe_50k.json")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    back = bpe.round_trip(docs.select(*COLUMNS, digest.alias("text_sha256")), path)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return back.select("doc_id", "lang", "source", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), (F.sha2("text", 256) == F.col("text_sha256")).alias("exact"), "text")


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*[F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in COLUMNS])


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Near-dedup and encoding have no SQL form here; the tests hold the whole against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
