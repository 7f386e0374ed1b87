"""Aggregate reports over results: status, sharing, flags, health, review, calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import urls
from lodestone.operators.matching import evidence
from lodestone.sources.stage import ranked

STATUSES = ("verified", "probable", "ambiguous", "no_match", "no_catalog", "url_dead")
# Score bands of the calibration sample, lowest score of each.
BANDS = ((0.95, "0.95-1.00"), (0.85, "0.85-0.95"), (0.75, "0.75-0.85"), (0.65, "0.65-0.75"), (0.55, "0.55-0.65"))


def status_for_csv(status: Column) -> Column:
    return F.when(status == "confident", "verified").otherwise(status)


def status_distribution(results: DataFrame, status: str = "status", names: tuple[str, ...] = STATUSES) -> DataFrame:
    """Rows and share of every status of ``names``, absent ones as 0."""
    spark = results.sparkSession
    known = spark.createDataFrame([(k, s) for k, s in enumerate(names)], "pos int, status string")
    counted = results.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("rows"))
    total = counted.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total"))
    out = known.join(counted, "status", "left").join(total)
    return out.select("pos", "status", F.coalesce("rows", F.lit(0)).alias("rows"), (F.coalesce("rows", F.lit(0)) * 100.0 / F.greatest("total", F.lit(1))).alias("share"))


def flag_histogram(df: DataFrame, flags: str = "flags") -> DataFrame:
    return df.select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count("*").alias("rows"))


def share_groups(results: DataFrame, *site: str, url: str = "url") -> DataFrame:
    """Urls that several rows hold, with their number of holders."""
    return results.where(F.col(url) != "").groupBy(*site, url).agg(F.count("*").alias("holders")).where("holders > 1")


def share_sizes(groups: DataFrame) -> DataFrame:
    return groups.groupBy("holders").agg(F.count("*").alias("urls"))


def largest_groups(groups: DataFrame, n: int = 5) -> DataFrame:
    return groups.orderBy(F.desc("holders"), "url").limit(n)


def diagnosis(reason: Column, healthy: Column, filled: Column, rows: Column) -> Column:
    """Why a site is filled as it is; a recorded reason outranks the figures."""
    out = F.when(F.coalesce(reason, F.lit("")).isin("blocked", "no_website", "no_hub", "no_candidates", "thin"), reason)
    out = out.when(~F.coalesce(healthy, F.lit(False)), "no catalog")
    return out.when(filled * 100 < rows * 20, "mistargeted").when(filled * 100 < rows * 50, "partial").otherwise("ok")


def institution_health(results: DataFrame, catalogs: DataFrame, institution: str = "institution_name", site: str = "site_key", url: str = "url") -> DataFrame:
    """Rows, filled rows and diagnosis of each institution; health is joined by site key."""
    counted = results.groupBy(institution, site).agg(F.count("*").alias("rows"), F.count_if(F.coalesce(url, F.lit("")) != "").alias("filled"))
    out = counted.join(catalogs.select(site, "healthy", "failure_reason"), site, "left")
    return out.withColumn("fill_pct", F.col("filled") * 100.0 / F.col("rows")).withColumn("diagnosis", diagnosis(F.col("failure_reason"), F.col("healthy"), F.col("filled"), F.col("rows")))


def headline(results: DataFrame, catalogs: DataFrame, said_not_found: Column | None = None) -> DataFrame:
    """One row: rows, filled, rows of unhealthy sites, filled against a "not found"."""
    joined = results.join(catalogs.select("site_key", "healthy"), "site_key", "left")
    filled = F.col("url") != ""
    disagrees = filled & said_not_found if said_not_found is not None else F.lit(False)
    starved = F.array_contains("flags", "url_claimed_by_stronger_match")
    return joined.agg(F.count("*").alias("rows"), F.count_if(filled).alias("filled"), F.count_if(~F.coalesce("healthy", F.lit(False))).alias("no_catalog_rows"), F.count_if(disagrees).alias("disagree"), F.count_if(starved).alias("starved"))


def review_queue(results: DataFrame, margin: str = "margin", score: str = "score", *tie: str) -> DataFrame:
    """Uncertain rows with their place in the queue, thinnest margin first."""
    return ranked(results.where(F.col("status").isin("probable", "ambiguous")), "rank", margin, F.desc(score), *(tie or ("id",)))


def score_band(score: Column) -> Column:
    out = F.when(score >= BANDS[0][0], BANDS[0][1])
    for least, name in BANDS[1:]:
        out = out.when(score >= least, name)
    return out.when(score > 0, "below-floor")


def calibration_sample(results: DataFrame, size: int = 150, seed: str = "20260828", score: str = "score", key: str = "id") -> DataFrame:
    """An equal number of rows from each score band that is not empty, in hashed order.

    Both the count of bands and the choice within one are relational; a band's
    rows are cut by rank of a hash, so the sample does not depend on input order.
    """
    banded = results.withColumn("score_band", score_band(F.col(score))).where("score_band is not null")
    bands = banded.agg(F.countDistinct("score_band").alias("_bands"))
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(":" + seed)))
    w = Window.partitionBy("score_band").orderBy("_h", key)
    ranked = banded.withColumn("_h", order).withColumn("_n", F.row_number().over(w)).join(F.broadcast(bands))
    per = F.greatest(F.lit(1), F.floor(F.lit(size) / F.greatest("_bands", F.lit(1))))
    return ranked.where(F.col("_n") <= per).drop("_h", "_n", "_bands")


def filled_csv(results: DataFrame, rows: DataFrame) -> DataFrame:
    """Columns of the delivered sheet, one row a course row."""
    own = rows.select("site_key", "id", "ord", "name", "institution_name", "notes", "prior_web_search", "website", F.col("flags").alias("_row_flags"), "prior_course_url", "prior_matched_status")
    df = own.join(results, ["site_key", "id"], "left")
    url = F.coalesce("url", F.lit(""))
    shown = lambda c: F.when(url != "", F.format_string("%.4f", c)).otherwise("")
    live = F.when(F.col("live_score").isNotNull(), F.format_string("%.4f", "live_score")).otherwise("") if "live_score" in results.columns else F.lit("")
    return df.select(
        "ord", "id", "name", "institution_name", url.alias("course_url"), F.col("notes").alias("Notes"), F.col("prior_web_search").alias("course_url_via_web_search"),
        shown("score").alias("matched_score"), status_for_csv(F.coalesce("status", F.lit("no_catalog"))).alias("matched_status"), "website", shown("margin").alias("match_margin"),
        live.alias("live_page_score"), F.coalesce(evidence(df), F.lit("")).alias("match_evidence"),
        F.concat_ws(";", F.concat("_row_flags", F.coalesce("flags", F.array().cast("array<string>")))).alias("row_flags"), "prior_course_url", "prior_matched_status",
        urls.classify_change(F.col("prior_course_url"), url).alias("url_change"),
    )


def coverage_markdown(results: DataFrame, catalogs: DataFrame) -> str:
    """The report as Markdown; every number comes from a distributed aggregate, one row a site at most reaches the driver."""

    def table(title: str, df: DataFrame, *columns: str) -> list[str]:
        body = [f"| {' | '.join(str(r[c]) for c in columns)} |" for r in df.select(*columns).toLocalIterator()]
        return [f"## {title}", "", f"| {' | '.join(columns)} |", "|" + "---|" * len(columns), *body, ""]

    top = headline(results, catalogs).first()
    lines = ["# Coverage", "", *(f"- {k}: **{v}**" for k, v in top.asDict().items()), ""]
    shown = results.withColumn("status", status_for_csv(F.col("status")))
    lines += table("Status", status_distribution(shown).orderBy("pos"), "status", "rows", "share")
    groups = share_groups(results, "site_key")
    lines += table("Shared urls", share_sizes(groups).orderBy("holders"), "holders", "urls")
    lines += table("Largest groups", largest_groups(groups), "url", "holders")
    lines += table("Flags", flag_histogram(results.withColumn("flags", F.transform("flags", lambda f: F.substring_index(f, "=", 1)))).orderBy(F.desc("rows"), "flag"), "flag", "rows")
    lines += table("Sites", catalogs.orderBy(F.desc("candidates"), "site_key"), "site_key", "candidates", "strategy", "healthy", "failure_reason")
    return "\n".join(lines)
