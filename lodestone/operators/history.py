"""Url history: keyed upsert, baseline, drift; run and catalogue records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import urls

COLUMNS = ("course_id", "url", "first_seen", "last_seen", "last_verified", "status", "first_run", "last_run")


def observe(rows: DataFrame, run_id: str, stamp: str) -> DataFrame:
    """Delivered urls of a run, ``(id, course_url, matched_status)``, as history rows."""
    status = F.when(F.trim("matched_status") == "confident", "verified").otherwise(F.trim("matched_status"))
    seen = rows.select(F.col("id").alias("course_id"), urls.clean_url(F.col("course_url")).alias("url"), status.alias("status")).where("url <> ''")
    seen = seen.dropDuplicates(["course_id", "url"])
    at, run = F.lit(stamp), F.lit(run_id)
    return seen.select("course_id", "url", at.alias("first_seen"), at.alias("last_seen"), F.when(F.col("status") == "verified", at).alias("last_verified"), "status", run.alias("first_run"), run.alias("last_run"))


def upsert_history(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new history as one row for each (course, url): one aggregation, safe to repeat."""
    both = old.select(*COLUMNS).unionByName(new.select(*COLUMNS))
    early, late = F.struct("first_seen", "first_run"), F.struct("last_seen", "last_run")
    return both.groupBy("course_id", "url").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.max("last_verified").alias("last_verified"),
        F.max_by("status", late).alias("status"), F.min_by("first_run", early).alias("first_run"), F.max_by("last_run", late).alias("last_run"),
    )


def latest_url(history: DataFrame) -> DataFrame:
    """Each course's latest url; of urls last seen together the greatest."""
    return history.groupBy("course_id").agg(F.max_by("url", F.struct("last_seen", "url")).alias("url"), F.max("last_seen").alias("last_seen"))


def moved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Courses whose new url differs from their latest old one."""
    before = latest_url(old).select("course_id", F.col("url").alias("previous"))
    return new.join(before, "course_id").where(F.col("url") != F.col("previous")).select("course_id", "previous", "url")


def seed_baseline(history: DataFrame, sheet: DataFrame, now: str, run_id: str = "source_sheet") -> DataFrame:
    """History with the sheet's own urls, ``(id, course_url, processed_date, matched_status)``, where they are not in it yet."""
    stamp = F.coalesce(F.nullif(F.trim("processed_date"), F.lit("")), F.lit(now))
    base = sheet.select(F.col("id").alias("course_id"), urls.clean_url(F.col("course_url")).alias("url"), stamp.alias("stamp"), F.nullif(F.trim("matched_status"), F.lit("")).alias("status"))
    base = base.where("url <> ''").dropDuplicates(["course_id", "url"]).join(history.select("course_id", "url"), ["course_id", "url"], "left_anti")
    rows = base.select("course_id", "url", F.col("stamp").alias("first_seen"), F.col("stamp").alias("last_seen"), F.lit(None).cast("string").alias("last_verified"), "status", F.lit(run_id).alias("first_run"), F.lit(run_id).alias("last_run"))
    return history.select(*COLUMNS).unionByName(rows)


def history_of(history: DataFrame, course_id) -> DataFrame:
    return history.where(F.col("course_id") == course_id).select("url", "first_seen", "last_seen", "last_verified", "status").orderBy("first_seen", "url")


def drifted(history: DataFrame, limit: int | None = 100) -> DataFrame:
    """Courses that have held more than one url, most urls first."""
    found = history.groupBy("course_id").agg(F.count("*").alias("urls")).where("urls > 1").orderBy(F.desc("urls"), "course_id")
    return found.limit(limit) if limit else found


def recent_runs(runs: DataFrame, limit: int = 20, started: str = "started", key: str = "run_id") -> DataFrame:
    return runs.orderBy(F.desc(started), F.desc(key)).limit(limit)


def latest_per_site(catalogs: DataFrame, site: str = "site_key", run: str = "run_id") -> DataFrame:
    """The newest run's record of each site."""
    others = [c for c in catalogs.columns if c != site]
    return catalogs.groupBy(site).agg(F.max_by(F.struct(*others), run).alias("r")).select(site, "r.*")


def changes_in_order(events: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """How often each key's value differs from the one before it."""
    w = Window.partitionBy(key).orderBy(*order)
    step = F.lag(value).over(w)
    return events.select(key, (step.isNotNull() & (step != F.col(value))).alias("c")).groupBy(key).agg(F.count_if("c").alias("changes"))
