"""Holding assigned urls against their pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import html, similarity, urls
from lodestone.operators.catalog import one_a_url
from lodestone.operators.matching import CONFIDENT
from lodestone.sources.stage import ranked


def targets(results: DataFrame) -> DataFrame:
    """Filled rows that are no duplicate's copy."""
    return results.where((F.col("url") != "") & ~F.array_contains("flags", "shared_with_duplicate_row"))


def verify(results: DataFrame, rows: DataFrame, pages: DataFrame, confident: float = CONFIDENT) -> DataFrame:
    """Results with ``live_score``; dead urls and weaker live titles change the status.

    ``rows``: site_key, id, name, institution_name; ``pages``: url, status, text.
    The page body is reduced to its heading before the join, so it is never shuffled.
    """
    heading = html.page_heading(F.col("text"))
    said = F.when(heading != "", heading).otherwise(html.page_title(F.col("text")))
    seen = pages.select(urls.clean_url(F.col("url")).alias("url"), "status", said.alias("_said"), (F.coalesce(F.length("text"), F.lit(0)) > 0).alias("_body"))
    seen = one_a_url(seen).select("url", F.col("status").alias("_http"), "_said", ((F.col("status") == 200) & F.col("_body")).alias("_ok"))
    keys = ["site_key", "id"]
    joined = results.join(rows.select(*keys, "name", "institution_name"), keys).join(seen, "url", "left")
    scored = similarity.score_pairs(joined.withColumnRenamed("score", "_score"), "name", "_said", "institution_name")
    filled, ok = F.col("url") != "", F.coalesce("_ok", F.lit(False))
    dead = filled & ~ok
    live = F.when(filled & ok, F.col("score"))
    weaker = filled & ok & (F.col("status") == "confident") & (F.col("score") < confident)
    flags = F.when(dead, F.array_append("flags", F.concat(F.lit("verify_http_"), F.coalesce(F.col("_http").cast("string"), F.lit("None"))))).when(weaker, F.array_append("flags", F.lit("live_title_weaker_than_listing"))).otherwise(F.col("flags"))
    status = F.when(dead, "url_dead").when(weaker, "probable").otherwise(F.col("status"))
    own = [c for c in results.columns if c not in ("score", "status", "flags", "live_score")]
    return scored.select(*own, F.col("_score").alias("score"), status.alias("status"), flags.alias("flags"), live.alias("live_score"))


def propagate(verified: DataFrame, items: DataFrame) -> DataFrame:
    """Give duplicates ``(site_key, id, rep_id)`` their representative's status and live score, not its flags."""
    reps = verified.join(items.where("id = rep_id").select("site_key", "id"), ["site_key", "id"], "left_semi").select("site_key", F.col("id").alias("rep_id"), F.col("status").alias("_s"), F.col("live_score").alias("_l"))
    out = verified.join(items.select("site_key", "id", "rep_id"), ["site_key", "id"]).join(reps, ["site_key", "rep_id"])
    return out.withColumns({"status": F.col("_s"), "live_score": F.col("_l")}).drop("_s", "_l", "rep_id")


def interleave(df: DataFrame, domain: str, order: str = "ord") -> DataFrame:
    """``df`` with ``turn``: round-robin over domains, domains in order of first appearance."""
    w = Window.partitionBy(domain)
    placed = df.withColumn("_round", F.row_number().over(w.orderBy(order))).withColumn("_first", F.min(order).over(w))
    return ranked(placed, "turn", "_round", "_first").drop("_round", "_first")
