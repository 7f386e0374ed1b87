"""Column functions over page bodies."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.names import let, name_tokens, one_of, squeeze, text_of

ANCHOR = r"""(?is)<a\b[^>]*?href\s*=\s*["']([^"']+)["'][^>]*>(.*?)</a>"""
# Anchor texts that are navigation.
NAV_STOPLIST = (
    "study", "courses", "course", "undergraduate", "postgraduate", "postgraduate taught", "postgraduate research", "preparation courses",
    "request prospectus", "request a prospectus", "apply", "apply now", "home", "contact", "contact us", "search", "more", "read more",
    "find out more", "view all", "view all courses", "see all", "next", "previous", "back", "overview", "about", "about us", "news", "events",
    "students", "staff", "alumni", "library", "research", "international", "fees", "fees and funding", "scholarships", "accommodation",
    "open day", "open days", "how to apply", "entry requirements", "student life", "why choose us", "our campus", "campus", "login", "log in",
    "register", "privacy", "cookies", "terms", "sitemap", "accessibility", "skip to content", "menu", "toggle menu", "close", "all courses",
    "browse courses", "subjects", "faculties", "schools", "departments", "a-z", "a to z",
)
# Fragments of page furniture.
NAV_SUBSTRINGS = (
    "skip navigation", "skip to", "go straight to", "main content", "cookie", "javascript", "screen reader", "toggle", "search this site",
    "back to top", "download the", "request information", "book an open", "enquire now", "chat with", "virtual tour", "order a prospectus",
)
# Labels of complete indexes.
INDEX_ANCHOR = (
    r"(?i)\b(a-?z|a to z|course finder|course search|find a course|all courses|browse courses|course list|search for a course|explore courses"
    r"|our courses|course catalogue|course catalog|program finder|programme finder|view all courses|full list)\b"
)
# Fixed value: what a not-found page says in its title or headings.
SOFT_404 = (
    r"(?i)\b(?:page|file|document)\s+not\s+found\b"
    r"|\berror\s*[:\-]?\s*40[34]\b"
    r"|\b40[34]\b\s*[:\-–|]?\s*(?:error|not\s+found|page)"
    r"|\bpage\s+(?:you\s+(?:\w+\s+){0,3})?(?:cannot|can\s?not|can'?t)\s+be\s+found\b"
    r"|\bpage\s+(?:you\s+(?:\w+\s+){0,3})?(?:does\s+not|doesn'?t)\s+exist\b"
    r"|\b(?:we|you)\s+(?:cannot|can\s?not|can'?t)\s+find\s+(?:that|the|this)\s+page\b"
    r"|\bnot\s+found\s*[|\-–]"
)
JSON_HINT = r"""(?i)["'](/(?:api|rest|data|services|umbraco|sitecore|wp-json)/[^"'\s]{4,120})["']"""


def flat_text(fragment: Column) -> Column:
    """A fragment without tags, white space collapsed; entities stay."""
    return squeeze(F.regexp_replace(text_of(fragment), "<[^>]+>", " "))


def page_title(html: Column) -> Column:
    return flat_text(F.regexp_extract(text_of(html), r"(?is)<title[^>]*>(.*?)</title>", 1))


def page_heading(html: Column) -> Column:
    return flat_text(F.regexp_extract(text_of(html), r"(?is)<h1[^>]*>(.*?)</h1>", 1))


def anchors(html: Column) -> Column:
    """``array<struct<href, text>>`` of all anchors, in order."""
    pattern = F.lit(ANCHOR)
    pairs = F.arrays_zip(F.regexp_extract_all(text_of(html), pattern, F.lit(1)).alias("href"), F.regexp_extract_all(text_of(html), pattern, F.lit(2)).alias("inner"))
    return F.transform(pairs, lambda p: F.struct(p["href"].alias("href"), flat_text(p["inner"]).alias("text")))


def sitemap_locs(xml: Column) -> Column:
    return F.regexp_extract_all(text_of(xml), F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))


def robots_sitemaps(text: Column) -> Column:
    """Targets of the ``Sitemap:`` lines of a robots file."""
    lines = F.filter(F.transform(F.split(text_of(text), "\r?\n"), lambda x: F.trim(x)), lambda x: F.lower(x).startswith("sitemap:"))
    return F.transform(lines, lambda x: F.trim(F.substr(x, F.lit(9))))


def json_hints(html: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text_of(html), F.lit(JSON_HINT), F.lit(1)))


def looks_like_soft_404(html: Column) -> Column:
    """A not-found page served with 200, as its title and headings say."""
    found = lambda pattern: F.regexp_extract_all(text_of(html), F.lit(pattern), F.lit(1))
    heads = F.concat(found(r"(?is)<title[^>]*>(.*?)</title>"), found(r"(?is)<h[12][^>]*>(.*?)</h[12]>"))
    return F.exists(heads, lambda h: flat_text(h).rlike(SOFT_404))


def looks_like_course_name(text: Column) -> Column:
    """Anchor text that is plausibly a name rather than navigation."""

    def judge(low: Column) -> Column:
        furniture = low.rlike("|".join(re.escape(part) for part in NAV_SUBSTRINGS))
        ruled_out = low.rlike(one_of(NAV_STOPLIST)) | (F.length(low) < 3) | (F.length(low) > 160) | furniture | low.rlike(r"^[^\p{L}_]+$")
        words = F.size(F.filter(F.split(low, r"(?U)\s+"), lambda w: w != ""))
        single = low.rlike("^[a-z]{2,12}$") & (F.size(name_tokens(text)) > 0)
        return ~ruled_out & ((words >= 2) | single)

    return (text_of(text) != "") & let(F.regexp_replace(F.lower(F.trim(text_of(text))), r"[ .›»>|]+$", ""), judge)


def shrink_page(text: Column) -> Column:
    """A body without scripts, styles, drawings and comments, JSON-LD kept at the end; untouched without ``<``."""

    def shrink(t: Column) -> Column:
        out = t
        for pattern in (r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>", r"(?is)<svg\b.*?</svg>", r"(?s)<!--.*?-->"):
            out = F.regexp_replace(out, pattern, " ")
        kept = F.regexp_extract_all(t, F.lit(r"(?is)<script[^>]*application/ld\+json.*?</script>"), F.lit(0))
        return F.when(F.contains(t, F.lit("<")), F.concat(squeeze(out), F.array_join(kept, ""))).otherwise(t)

    return F.when(text.isNotNull(), let(text, shrink))
