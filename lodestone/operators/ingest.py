"""From sheets to course rows: projection, repair, flags, grouping keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import names, urls
from lodestone.functions.names import let, text_of
from lodestone.sources.stage import ranked

# Names that are a credential without a subject.
BARE_CREDENTIALS = (
    "ielts", "pte", "toefl", "toeic", "ossd", "sace", "elicos", "eap", "mba", "gre", "gmat", "cae", "fce", "celta", "delta", "hsc", "vce",
    "atar", "ib", "gcse", "a level", "a levels", "foundation", "general english", "english", "academic english", "esl",
)
# Patterns of row flags.
K12 = r"(?i)\b(primary\s+school|secondary\s+college|secondary\s+school|high\s+school|infants?\s+school|p-[0-9]+\s+college|primary\s+&?\s*secondary)\b"
YEAR_LEVEL = r"(?i)^\s*(year|grade|prep|kindergarten|kinder|foundation\s+year)\b|^\s*year\s+level\s*:"
OCCUPATION = r"(?i)\(\s*subclass\s*[0-9]+\s*\)|\b[0-9]{6}\b\s*\("
AGGREGATOR = r"(?i)\b(shorelight|studygroup|study-group|navitas|kaplan|idp|educations?\.com|hotcourses|studyportals)\b"
URL_IN_TEXT = r"""https?://[^\s,"']+"""
NON_COURSE_FLAGS = ("occupation_code_not_course", "year_level_not_course")
MAX_MERGE = 5


def _count(text: Column, c: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))


def balanced(text: Column) -> Column:
    """No more opening than closing parentheses."""
    return _count(text, "(") <= _count(text, ")")


def row_flags(name: Column, institution: Column, website: Column) -> Column:
    """Why a weak or missing result is to be expected, in fixed order."""
    subject = F.size(names.name_tokens(name, True)) == 0
    rules = (
        (text_of(institution).rlike(K12), "k12_institution"),
        (text_of(name).rlike(YEAR_LEVEL), "year_level_not_course"),
        (subject | F.lower(F.trim(text_of(name))).isin(*BARE_CREDENTIALS), "bare_credential_name"),
        (text_of(name).rlike(OCCUPATION), "occupation_code_not_course"),
        (~balanced(text_of(name)), "truncated_name"),
        (text_of(website).rlike(AGGREGATOR), "aggregator_website"),
        (~text_of(website).rlike(r"^(https?://|www\.)"), "unusable_website"),
    )
    return F.filter(F.array(*[F.when(c, F.lit(f)) for c, f in rules]), lambda f: f.isNotNull())


def work_name(name: Column) -> Column:
    """A name up to case, white space and end punctuation."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text_of(name))), r"(?U)\s+", " "), r"^[ .,;:-]+|[ .,;:-]+$", "")


def institution_key(institution_id: Column, institution_name: Column) -> Column:
    return F.coalesce(F.nullif(institution_id, F.lit("")), F.lower(F.trim(text_of(institution_name))))


def prior_note_url(web_search: Column, notes: Column) -> Column:
    """The first url in the web-search note, else in the notes, else ''."""
    first = lambda c: F.nullif(F.regexp_extract(text_of(c), f"({URL_IN_TEXT})", 1), F.lit(""))
    return F.coalesce(first(web_search), first(notes), F.lit(""))


def prior_urls(course_url: Column, program_link: Column, note_url: Column) -> Column:
    """Distinct http(s) urls that earlier work tied to a row, best first."""
    return F.array_distinct(F.filter(F.transform(F.array(text_of(course_url), text_of(program_link), text_of(note_url)), lambda u: F.trim(u)), lambda u: u.rlike("^https?://")))


def prior_said_not_found(notes: Column, web_search: Column) -> Column:
    no = lambda c: F.lower(F.trim(text_of(c))) == "not found"
    return no(notes) | no(web_search)


def score_is_foreign(value: Column) -> Column:
    """Whether a score is on another scale than 0 to 1; false where it is no number."""
    return F.coalesce(value.try_cast("double") > 1.0, F.lit(False))


def course_rows(sheet: DataFrame, flags: Column | None = None) -> DataFrame:
    """Course rows of a sheet read by :func:`lodestone.sources.tables.read_csv`.

    Columns that a sheet lacks are ''. ``flags`` are put before the row's own.
    """
    have = {c.lower(): c for c in sheet.columns}
    col = lambda *options: next((F.col(f"`{have[o]}`") for o in options if o in have), F.lit(""))
    out = sheet.select(
        *([F.col("ord")] if "ord" in sheet.columns else [F.monotonically_increasing_id().alias("ord")]),
        col("id").alias("id"), col("name").alias("name"), col("institution_name").alias("institution_name"), col("institution_id").alias("institution_id"),
        col("website").alias("website"), col("notes").alias("notes"), col("course_url_via_web_search").alias("prior_web_search"),
        col("course_url").alias("prior_course_url"), col("program_link").alias("program_link"), col("batch_id").alias("batch_id"),
        col("processed_date").alias("processed_date"), col("matched_status").alias("prior_matched_status"),
        *([flags.alias("_first")] if flags is not None else []),
    )
    own = row_flags(F.col("name"), F.col("institution_name"), F.col("website"))
    return out.withColumns(
        {
            "flags": F.concat("_first", own) if flags is not None else own,
            "site_host": urls.host_of(F.col("website")),
            "institution_key": institution_key(F.col("institution_id"), F.col("institution_name")),
            "work_name": work_name(F.col("name")),
            "prior_urls": prior_urls(F.col("prior_course_url"), F.col("program_link"), prior_note_url(F.col("prior_web_search"), F.col("notes"))),
        }
    ).drop("_first")


def registry(lines: DataFrame) -> DataFrame:
    """Corroborated institutions of a ragged legacy sheet: ``institution, website``.

    Only lines with more than eight fields count; an institution is known if its
    name occurs twice or more, or stands with a plausible website; its first
    website counts.
    """
    site = F.get("fields", F.lit(8))
    plausible = F.coalesce(site.rlike(r"^(https?://|www\.)"), F.lit(False))
    wide = lines.where(F.size("fields") > 8).select(F.lower(F.trim(F.get("fields", F.lit(2)))).alias("institution"), "ord", F.when(plausible, site).alias("site"))
    known = wide.where("institution <> ''").groupBy("institution").agg(F.count("*").alias("n"), F.min_by("site", F.when(F.col("site").isNotNull(), F.col("ord"))).alias("website"))
    return known.where("n > 1 or website is not null").select("institution", "website")


def _merge_until(fields: Column, done, most: int) -> Column:
    """Join fields 1 and 2 with a comma until ``done`` holds, ``most`` times at most."""

    def step(state: Column, _: Column) -> Column:
        joined = F.concat(F.slice(state, 1, 1), F.array(F.concat(F.get(state, F.lit(1)), F.lit(","), F.get(state, F.lit(2)))), F.slice(state, 4, F.greatest(F.size(state) - 3, F.lit(0))))
        return F.when(done(state) | (F.size(state) <= 3), state).otherwise(joined)

    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), fields, step)


def repair_lines(lines: DataFrame) -> DataFrame:
    """Rejoin names that an unquoted comma has split over several fields.

    A line whose third field is a known institution is sound. Else, if a known
    institution stands further right, fields are joined until it is third (four
    times at most, or the line stays as it is); else, if a url's host belongs to
    a known institution, fields are joined until the parentheses balance. Adds
    ``repaired`` and ``institution`` (inferred from the host, else '').
    The registry has one row an institution and is kept as one array of names.
    """
    known = registry(lines)
    low = lambda x: F.lower(F.trim(x))
    host = lambda u: F.regexp_replace(F.lower(F.regexp_extract(u, r"^https?://([^/]*)", 1)), r"^www\.", "")
    by_host = known.where("website is not null").groupBy(host(urls.normalise_website(F.col("website"))).alias("host")).agg(F.min("institution").alias("institution"))
    exploded = lines.select("ord", F.posexplode("fields").alias("k", "v"))
    targets = exploded.where("k >= 2").join(known.select(F.col("institution").alias("v_low")), low(F.col("v")) == F.col("v_low"), "left_semi")
    targets = targets.groupBy("ord").agg(F.min("k").alias("k"), F.min_by(low(F.col("v")), "k").alias("target"))
    sites = exploded.where(F.col("v").rlike(URL_IN_TEXT)).withColumn("host", host(F.regexp_extract("v", f"({URL_IN_TEXT})", 1))).join(by_host, "host")
    sites = sites.groupBy("ord").agg(F.min_by("institution", "k").alias("inferred"))
    out = lines.join(targets, "ord", "left").join(sites, "ord", "left")
    third = lambda s, t: low(F.get(s, F.lit(2))) == t
    merged_a = _merge_until(F.col("fields"), lambda s: third(s, F.col("target")), MAX_MERGE - 1)
    merged_b = _merge_until(F.col("fields"), lambda s: balanced(F.get(s, F.lit(1))), MAX_MERGE)
    tidy = lambda s: F.concat(F.slice(s, 1, 1), F.array(F.trim(F.regexp_replace(F.get(s, F.lit(1)), r"[,\s]+$", ""))), F.slice(s, 3, F.greatest(F.size(s) - 2, F.lit(0))))
    damaged = (F.size("fields") >= 4) & ~F.coalesce(F.col("k") == 2, F.lit(False))
    by_name = damaged & F.coalesce(third(merged_a, F.col("target")), F.lit(False)) & (F.col("k") > 2)
    by_site = damaged & F.col("k").isNull() & F.col("inferred").isNotNull()
    return out.select(
        "ord",
        F.when(by_name, tidy(merged_a)).when(by_site, tidy(merged_b)).otherwise(F.col("fields")).alias("fields"),
        F.coalesce(by_name | by_site, F.lit(False)).alias("repaired"),
        F.when(by_site, F.col("inferred")).otherwise("").alias("institution"),
    )


def legacy_rows(lines: DataFrame) -> DataFrame:
    """Course rows of a ragged legacy sheet (header line excluded), repaired lines flagged."""
    known = registry(lines)
    fixed = repair_lines(lines).withColumn("inst", F.when(F.col("institution") != "", F.col("institution")).otherwise(F.lower(F.trim(F.get("fields", F.lit(2))))))
    fixed = fixed.join(known.withColumnRenamed("institution", "inst").withColumnRenamed("website", "known_site"), "inst", "left")
    field = lambda k: F.trim(F.coalesce(F.get("fields", F.lit(k)), F.lit("")))
    rest = F.concat_ws(" ", F.filter(F.slice("fields", 4, F.greatest(F.size("fields") - 3, F.lit(0))), lambda x: F.trim(x) != ""))
    sheet = fixed.select(
        "ord", field(0).alias("id"), field(1).alias("name"), F.when(F.col("institution") != "", F.col("institution")).otherwise(field(2)).alias("institution_name"),
        F.when(F.col("repaired"), F.coalesce("known_site", F.lit(""))).otherwise(field(8)).alias("website"),
        F.when(F.col("repaired"), rest).otherwise(field(4)).alias("notes"),
        F.when(F.col("repaired"), "").otherwise(field(5)).alias("course_url_via_web_search"), F.when(F.col("repaired"), "").otherwise(field(7)).alias("matched_status"),
        F.when(F.col("repaired"), F.array(F.lit("malformed_row_repaired"))).otherwise(F.array().cast("array<string>")).alias("first_flags"),
    )
    return course_rows(sheet, F.col("first_flags"))


def work_items(rows: DataFrame, *keys: str, order: str = "ord") -> DataFrame:
    """``rows`` with ``is_rep`` (first of its work item), ``duplicates`` and ``rep_id``."""
    w = Window.partitionBy(*keys)
    return rows.withColumns(
        {"is_rep": F.row_number().over(w.orderBy(order)) == 1, "duplicates": F.count("*").over(w), "rep_id": F.first("id").over(w.orderBy(order))}
    )


def most_frequent(df: DataFrame, key: str, value: str) -> DataFrame:
    """Each key's most frequent non-empty value; of equals the smallest."""
    counted = df.where(F.col(value) != "").groupBy(key, value).agg(F.count("*").alias("n"))
    return counted.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value), F.max("n").alias("n"))


def site_ranking(rows: DataFrame, site: str = "site_host") -> DataFrame:
    """Sites with their rows, those that may be courses first."""
    course = ~F.arrays_overlap("flags", F.array(*map(F.lit, NON_COURSE_FLAGS)))
    counted = rows.where(F.col(site) != "").groupBy(site).agg(F.count_if(course).alias("course_rows"), F.count("*").alias("rows"))
    return ranked(counted, "rank", F.desc("course_rows"), F.desc("rows"), site)


def keep_institutions(rows: DataFrame, wanted: list[str], site: str = "site_host") -> DataFrame:
    """All rows of the sites on which any wanted institution has a row."""
    sites = rows.where(F.lower("institution_name").isin(*[w.lower() for w in wanted])).select(site).distinct()
    return rows.join(sites, site, "left_semi")


def suggestions(rows: DataFrame, most: int = 10, site: str = "site_host") -> DataFrame:
    """The largest sites with their rows and most frequent institution, to choose from."""
    counted = rows.where(F.col(site) != "").groupBy(site).agg(F.count("*").alias("rows"))
    largest = counted.orderBy(F.desc("rows"), site).limit(most)
    return largest.join(most_frequent(rows.join(largest, site, "left_semi"), site, "institution_name").select(site, "institution_name"), site, "left").orderBy(F.desc("rows"), site)


def load_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("rows"), F.countDistinct("institution_key").alias("institutions"), F.countDistinct(F.nullif("site_host", F.lit(""))).alias("sites"),
        F.count_if(F.col("site_host") == "").alias("rows_without_website"), F.countDistinct("institution_key", "work_name").alias("work_items"),
        F.count_if(F.size("prior_urls") > 0).alias("rows_with_prior_url"),
    )
