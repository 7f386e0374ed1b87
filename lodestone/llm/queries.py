"""Queries over whole tables that apply the corpus operators, and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, decontaminate, linededup, minhash, quality, sharding, tokencount, toxicity, urlfilter, warc

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards of near-equal bytes, equal texts together."""
    return sharding.shard(table(spark, sf_dir, "documents"), 24).drop("group_key")


@query
def op2_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, similarity 0.85 or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


ORACLES["op2_bbit_minhash"] = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingled AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words
), classes AS MATERIALIZED (
  SELECT min(doc_id) AS rep, list_sort(s) AS s, len(s) AS n FROM shingled WHERE len(s) > 0 GROUP BY list_sort(s), len(s)
), each AS MATERIALIZED (
  SELECT rep, n, unnest(s) AS x FROM classes
), common AS (
  SELECT a.rep AS u, b.rep AS v, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS k
  FROM each a JOIN each b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY ALL
), links AS MATERIALIZED (
  SELECT u, v FROM common WHERE 100 * k >= 85 * (m + n - k)
), both_ways AS MATERIALIZED (
  SELECT u, v FROM links UNION SELECT v, u FROM links
), reach(a, b) AS (
  SELECT rep, rep FROM classes
  UNION
  SELECT r.a, e.v FROM reach r JOIN both_ways e ON r.b = e.u
), grouped AS (
  SELECT a AS rep, min(b) AS component FROM reach GROUP BY a
), class_of AS (
  SELECT d.doc_id, c.rep FROM shingled d JOIN classes c ON list_sort(d.s) = c.s
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(g.component, d.doc_id) AS component_id, coalesce(g.component, d.doc_id) = d.doc_id AS kept
FROM shingled d LEFT JOIN class_of c ON d.doc_id = c.doc_id LEFT JOIN grouped g ON c.rep = g.rep
"""


@query
def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the line-first rules for all documents."""
    return quality.clean_and_judge(table(spark, sf_dir, "documents")).drop("clean_text")


_quoted = lambda s: "'" + s.replace("'", "''") + "'"
_PHRASES = " OR ".join(f"contains(lower(line), {_quoted(p)})" for p in quality.BOILERPLATE)
_MENU = ", ".join(map(_quoted, quality.NAVIGATION))
_CLOSING = ", ".join(map(_quoted, quality.CLOSING))
_BARE = "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
ORACLES["op6_line_rules"] = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents
), w AS MATERIALIZED (
  SELECT k, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d
), grams AS MATERIALIZED (
  SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), twice AS (
  SELECT k, unnest([i, i + 1, i + 2]) AS p FROM grams JOIN (SELECT k, g FROM grams GROUP BY k, g HAVING count(*) > 1) USING (k, g)
), repeated AS (
  SELECT k, count(DISTINCT p) AS n_repeat_words FROM twice GROUP BY k
), lines AS MATERIALIZED (
  SELECT k, line FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), judged AS (
  SELECT k, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
    ({_PHRASES} OR lower({_BARE}) IN ({_MENU}) OR (n_words >= 10 AND right({_BARE}, 1) NOT IN ({_CLOSING}))
     OR (bars >= 3 AND bars * 4 >= n_words) OR symbols > length(line) * CAST(0.1 AS DOUBLE) OR (shouts > 0 AND shouts * 5 >= n_words)) AS bad
  FROM (SELECT *, length(line) - length(replace(line, '|', '')) AS bars,
      length(line) - length(translate(line, '#*$%&|<>{{}}', '')) AS symbols,
      len(regexp_extract_all(line, '[!?]{{2,}}(?:[\x20\x09-\x0D]|\z)')) AS shouts,
      length({_BARE}) - length(replace({_BARE}, ' ', '')) + 1 AS n_words FROM lines)
), summed AS (
  SELECT k, count(*) AS n_lines, count(*) FILTER (bad) AS n_failed_lines, coalesce(sum(chars) FILTER (bad), 0) AS lost_chars, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM judged GROUP BY k
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines,
    CAST(coalesce(n_failed_lines, 0) AS INTEGER) AS n_failed_lines, CAST(coalesce(lost_chars, 0) AS BIGINT) AS lost_chars
  FROM w LEFT JOIN repeated USING (k) LEFT JOIN summed USING (k)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AS base_failed,
  NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50 OR lost_chars > word_chars * CAST(0.3 AS DOUBLE) OR n_dup_lines * 2 > n_lines) AS kept, n_lines, n_failed_lines, lost_chars
FROM base
"""


@query
def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, fitting rule and verdict for the url of every page."""
    return urlfilter.judge_urls(table(spark, sf_dir, "pages")).drop("score")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents under word_bpe_49k.json, and which exceed 2048."""
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in 10-word windows of benchmark items."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    digest = F.sha2(F.array_join(F.array_sort("items"), ","), 256)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (hit > 0).alias("contaminated"))


ORACLES["op7_aho_corasick"] = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents
), b AS MATERIALIZED (
  SELECT item_id, w, least(len(w), 10) AS size FROM (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark)
  WHERE len(w) > 0
), wins AS MATERIALIZED (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM b)
), sizes AS (
  SELECT DISTINCT size FROM wins
), spots AS MATERIALIZED (
  SELECT k, i, size, array_to_string(w[i : i + size - 1], ' ') AS g FROM (SELECT k, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), found AS MATERIALIZED (
  SELECT k, i, size, item_id FROM spots JOIN wins USING (size, g)
), words AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + size)) AS p FROM found) GROUP BY k
), items AS (
  SELECT k, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN items USING (k)
"""


@query
def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through WARC files and back: sizes, digests, revisits."""
    back = warc.archive_pages(table(spark, sf_dir, "pages"))
    number = lambda c: F.regexp_extract(c, r"urn:page:(-?\d+)", 1).try_cast("long")
    return back.select(
        number("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), "payload_length").alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


ORACLES["op5_warc_archive"] = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query
def op4_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents under byte_bpe_50k.json and their text decoded again, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    kept = ids.select("doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"))
    back = bpe.decode(kept, path)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


@query
def op3_patience_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that an earlier document holds."""
    clean = linededup.remove_shared_passages(table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_lines", "n_deleted", "kept", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"), "text")


@query
def op8_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; learnt from the labelled rows that are not held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    known = table(spark, sf_dir, "labels").where(~held_out)
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), known)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
