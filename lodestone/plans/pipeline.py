"""The two runs as compositions of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import urls
from lodestone.operators import catalog, history, ingest, matching, triage, verify
from lodestone.operators.matching import Thresholds
from lodestone.sources.stage import staged


def sites_of(rows: DataFrame) -> DataFrame:
    """One row a site: majority website, display name, work items; rows without a site stay out."""
    placed = rows.where("site_host <> ''").withColumn("web", urls.normalise_website(F.col("website")))
    web = ingest.most_frequent(placed, "site_host", "web").select("site_host", F.col("web").alias("website"))
    named = ingest.most_frequent(placed, "site_host", "institution_name").select("site_host", F.col("institution_name").alias("institution"))
    counted = placed.groupBy("site_host").agg(F.count("*").alias("expected_rows"))
    return counted.join(web, "site_host").join(named, "site_host", "left").withColumnRenamed("site_host", "site_key")


def ranked_priors(rows: DataFrame) -> DataFrame:
    """Prior urls of each site, most frequent first, as ``(site_key, ord, url)``."""
    found = rows.where("site_host <> ''").select(F.col("site_host").alias("site_key"), F.explode("prior_urls").alias("url")).groupBy("site_key", "url").agg(F.count("*").alias("n"))
    return found.select("site_key", F.row_number().over(_order("site_key", F.desc("n"), "url")).alias("ord"), "url")


def _order(key: str, *by):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(*by)


def phase1(rows: DataFrame, pages: DataFrame, thresholds: Thresholds = Thresholds(), verified: bool = True, include_no_site: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(results, catalogs, candidates)`` for course rows and stored pages.

    ``rows`` as made by :func:`lodestone.operators.ingest.course_rows`; ``pages``:
    url, status, final_url, text. Sites without a healthy catalogue give
    ``no_catalog`` rows; duplicates share their representative's result.
    """
    sites = sites_of(rows)
    hosted = pages.withColumn("site_key", urls.registrable(urls.netloc_of(F.col("url"))))
    candidates, catalogs = catalog.build_catalogs(sites, hosted, ranked_priors(rows))
    placed = rows.where("site_host <> ''").withColumnRenamed("site_host", "site_key")
    items = ingest.work_items(placed, "site_key", "institution_key", "work_name")
    items = staged(items, "items")
    open_sites = catalogs.where("candidates > 0").select("site_key")
    institutions = sites.select("site_key", F.col("institution").alias("site_institution"))
    reps = items.where("is_rep").join(open_sites, "site_key", "left_semi").join(institutions, "site_key").select("site_key", "id", "name", F.coalesce("site_institution", "institution_name").alias("institution_name"))
    listed = candidates.select("site_key", F.col("ord").cast("int").alias("cand_ord"), F.col("name").alias("cand_name"), "url", "level", "source")
    own = listed.select("site_key", urls.registrable(urls.netloc_of(F.col("url"))).alias("domain")).distinct()
    results = staged(matching.assign(reps, listed, own, thresholds), "assigned")
    results = matching.fan_out(results, items)
    shut = items.join(open_sites, "site_key", "left_anti").select("site_key", "id")
    if include_no_site:
        shut = shut.unionByName(rows.where("site_host = ''").select(F.col("site_host").alias("site_key"), "id"))
    blank = shut.select(
        "site_key", "id", F.lit("").alias("url"), F.lit(0.0).alias("score"), F.lit(0.0).alias("margin"), F.lit("no_catalog").alias("status"), F.array().cast("array<string>").alias("flags")
    )
    results = results.unionByName(blank, allowMissingColumns=True).fillna(0.0, ["runner_up_score"])
    if verified:
        seen = verify.verify(results, placed.select("site_key", "id", "name", "institution_name"), pages, thresholds.confident)
        results = verify.propagate(seen, items.select("site_key", "id", "rep_id"))
    return results, catalogs, candidates


def phase2(results: DataFrame, source: DataFrame, old_history: DataFrame, run_id: str, stamp: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(triaged, history, moved)``: prior urls weighed, baseline seeded, history kept."""
    triaged = triage.triage(results, source)
    base = history.seed_baseline(old_history, source, stamp)
    seen = history.observe(triaged, run_id, stamp)
    return triaged, history.upsert_history(base, seen), history.moved(base, seen)
