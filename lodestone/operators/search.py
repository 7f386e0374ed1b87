"""Which rows a search would be asked about, and with what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import urls
from lodestone.functions.names import squeeze, text_of

# Flags of rows that no search can help.
UNSEARCHABLE = ("occupation_code_not_course", "year_level_not_course")


def is_searchable(url: Column, flags: Column) -> Column:
    """No url yet, and no flag (a substring of the joined flags) that rules a page out."""
    free = F.trim(text_of(url)) == ""
    for flag in UNSEARCHABLE:
        free = free & ~F.contains(text_of(flags), F.lit(flag))
    return free


def build_query(name: Column, institution: Column, site: Column) -> Column:
    name, institution = squeeze(text_of(name)), squeeze(text_of(institution))
    return F.concat_ws(" ", F.when(name != "", F.concat(F.lit('"'), name, F.lit('"'))), F.nullif(institution, F.lit("")), F.when(text_of(site) != "", F.concat(F.lit("site:"), site)))


def search(rows: DataFrame, results: DataFrame) -> DataFrame:
    """Searchable rows with ``query`` and the on-site urls of stored ``results (query, urls)``."""
    site = urls.host_of(F.col("website"))
    asked = rows.where(is_searchable(F.col("course_url"), F.col("row_flags"))).withColumns({"site": site, "query": build_query(F.col("name"), F.col("institution_name"), site)})
    hits = F.filter(F.coalesce("urls", F.array().cast("array<string>")), lambda u: urls.on_site(u, F.col("site")))
    return asked.join(results, "query", "left").withColumn("hits", hits).drop("urls")
