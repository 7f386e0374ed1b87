"""Candidates of a site: links, merging, health, seeds, crawl, sitemaps, JSON, the ladder."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import html, names, urls
from lodestone.sources.stage import staged

# Where course listings are looked for.
HUB_PATHS = (
    "/courses", "/study", "/courses/", "/study/", "/course-search", "/undergraduate", "/postgraduate", "/study/courses", "/programs",
    "/programmes", "/study-with-us", "/our-courses", "/course-finder", "/study/undergraduate", "/study/postgraduate", "/academics",
)
HUB_SUBDOMAINS = ("courses", "study", "programs", "programmes", "catalogue", "catalog", "handbook")
NAME_KEYS = ("title", "name", "coursename", "course_name", "courseTitle", "programName", "displayName", "heading")
URL_KEYS = ("url", "link", "href", "path", "slug", "courseUrl", "permalink")
# Bounds of extraction.
REFUSALS, REFUSAL_SHARE = (401, 403, 429, 451), 0.8
MIN_BUDGET, MAX_BUDGET, PAGES_PER_ROW = 40, 400, 3
MAX_PER_URL, MAX_DEPTH, MIN_CANDIDATES, HEALTH_RATIO = 12, 2, 5, 0.40
MAX_SITEMAPS, MAX_ENDPOINTS, MAX_JSON_SEEDS, MAX_PRIOR, MAX_PARENTS = 25, 12, 6, 400, 12
SCHEMA_VERSION = 3
SOURCE_RANK = {"listing": 3, "json": 2, "prior": 1, "sitemap": 0}


def page_budget(rows: Column) -> Column:
    return F.greatest(F.lit(MIN_BUDGET), F.least(F.lit(MAX_BUDGET), F.greatest(rows, F.lit(0)) * PAGES_PER_ROW + 20))


def healthy(candidates: Column, expected: Column) -> Column:
    return (candidates >= MIN_CANDIDATES) & (candidates >= expected * HEALTH_RATIO)


def links(pages: DataFrame, *keep: str, url: str = "url", body: str = "html") -> DataFrame:
    """All anchors of pages as ``(keep..., pos, anchor, link)``, hrefs resolved, links cleaned."""
    found = pages.select(*keep, F.col(url).alias("_base"), F.posexplode(html.anchors(F.col(body))).alias("pos", "a"))
    return found.select(*keep, "pos", F.col("a.text").alias("anchor"), urls.clean_url(urls.resolve(F.col("_base"), F.col("a.href"))).alias("link"))


def merge_candidates(df: DataFrame, *site: str, name: str = "name", url: str = "url", source: str = "source", ord_: str = "ord") -> DataFrame:
    """One candidate for each (url, stem): the best source, then the longest name, then the earliest.

    Keeps the first appearance as ``ord``. One aggregation with partial sums.
    """
    rank = F.lit(0)
    for s, r in SOURCE_RANK.items():
        rank = F.when(F.col(source) == s, F.lit(r)).otherwise(rank)
    best = F.struct(rank.alias("r"), F.length(name).alias("n"), (-F.col(ord_)).alias("o"))
    others = [c for c in df.columns if c not in (*site, url, ord_, "stem")]
    out = df.withColumn("stem", names.variant_stem(F.col(name))).groupBy(*site, url, "stem").agg(F.max_by(F.struct(*others), best).alias("c"), F.min(ord_).alias(ord_))
    return out.select(*site, url, "stem", "c.*", ord_)


def drop_institution_names(df: DataFrame, *site: str, institution: str = "institution") -> DataFrame:
    """Names without their institution's, merged anew."""
    bare = names.strip_institution(F.col("name"), F.col(institution))
    return merge_candidates(df.withColumn("name", F.when(bare == "", F.col("name")).otherwise(bare)), *site)


def cap_per_url(df: DataFrame, *site: str, most: int = MAX_PER_URL) -> DataFrame:
    """All rows of the first ``most`` stems of each url; ``df`` has ``url``, ``stem`` and ``ord``."""
    first = df.withColumn("_first", F.min("ord").over(Window.partitionBy(*site, "url", "stem")))
    return first.withColumn("_n", F.dense_rank().over(Window.partitionBy(*site, "url").orderBy("_first"))).where(F.col("_n") <= most).drop("_n", "_first")


def extraction_health(candidates: DataFrame, expected: DataFrame, site: str = "site_key") -> DataFrame:
    """``site, expected_rows, candidates, healthy`` for every site of ``expected (site, expected_rows)``."""
    counted = candidates.groupBy(site).agg(F.count("*").alias("candidates"))
    out = expected.join(counted, site, "left").fillna(0, ["candidates"])
    return out.withColumn("healthy", healthy(F.col("candidates"), F.col("expected_rows")))


def status_histogram(fetches: DataFrame, *keys: str, status: str = "status") -> DataFrame:
    return fetches.where(F.col(status).isNotNull()).groupBy(*keys, status).agg(F.count("*").alias("n"))


def probe_verdicts(histogram: DataFrame, *keys: str, status: str = "status") -> DataFrame:
    """``resolved, verdict`` (blocked, no_hub or '') and ``refusing`` of each host's statuses."""
    refused = F.coalesce(F.sum(F.when(F.col(status).isin(*REFUSALS), F.col("n"))), F.lit(0))
    ok = F.coalesce(F.sum(F.when(F.col(status) == 200, F.col("n"))), F.lit(0))
    out = histogram.groupBy(*keys).agg(F.sum("n").alias("resolved"), refused.alias("refused"), ok.alias("ok"))
    verdict = F.when(F.col("refused") >= F.col("resolved") * REFUSAL_SHARE, "blocked").when(F.col("ok") == 0, "no_hub").otherwise("")
    return out.select(*keys, "resolved", verdict.alias("verdict"), ((F.col("refused") > 0) & (F.col("ok") == 0)).alias("refusing"))


def one_a_url(pages: DataFrame, *keys: str) -> DataFrame:
    """One row for each url: the last by status 200, then by all columns in order, so the choice is defined."""
    keys = keys or ("url",)
    others = [c for c in pages.columns if c not in keys]
    best = F.struct((F.col("status") == 200).alias("ok"), F.struct(*others).alias("row")) if "status" in others else F.struct(F.struct(*others).alias("row"))
    return pages.groupBy(*keys).agg(F.max(best).alias("b")).select(*keys, "b.row.*")


def hub_probes(sites: DataFrame) -> DataFrame:
    """All probe urls of ``sites (site_key, website)`` in order: hub paths, then subdomains."""
    host = urls.netloc_of(F.col("website"))
    base = F.concat(F.coalesce(F.nullif(urls.scheme_of(F.col("website")), F.lit("")), F.lit("https")), F.lit("://"), host)
    paths = [F.struct(F.lit(k).alias("k"), F.lit("path").alias("kind"), F.concat(base, F.lit(p)).alias("url")) for k, p in enumerate(HUB_PATHS)]
    apex = F.regexp_replace(host, r"^www\.", "")
    subs = [F.struct(F.lit(100 + k).alias("k"), F.lit("subdomain").alias("kind"), F.concat(F.lit(f"https://{s}."), apex, F.lit("/")).alias("url")) for k, s in enumerate(HUB_SUBDOMAINS)]
    return sites.select("site_key", F.explode(F.array(*paths, *subs)).alias("p")).select("site_key", "p.*")


def find_seeds(sites: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Listing roots ``(site_key, k, seed)`` and the probe histogram ``(site_key, status, n)``.

    ``pages``: url, status, final_url, text. Sign-in pages and soft 404s are no
    seeds; a soft 404 counts as the 404 it is.
    """
    body = F.coalesce(F.length("text"), F.lit(0)) > 0
    # What is asked of a body is asked before the join; bodies are not shuffled.
    seen = one_a_url(pages.select("url", "status", "final_url", body.alias("body"), F.coalesce(html.looks_like_soft_404(F.col("text")), F.lit(False)).alias("soft")))
    probed = hub_probes(sites).join(seen, "url", "left")
    ok = (F.col("status") == 200) & F.col("body")
    final = urls.clean_url(F.col("final_url"))
    soft = ok & F.col("soft")
    auth = ok & urls.path_of(final).rlike(urls.AUTH_PATH)
    judged = probed.select("site_key", "k", "kind", final.alias("seed"), F.when(soft & ~auth, F.lit(404)).otherwise(F.col("status")).alias("status"), (ok & ~soft & ~auth).alias("good"))
    seeds = judged.where(F.col("good") & (F.col("seed") != "")).groupBy("site_key", "seed").agg(F.min("k").alias("k"))
    return seeds, status_histogram(judged.where("kind = 'path'"), "site_key")


def prior_parents(priors: DataFrame, most: int = MAX_PARENTS) -> DataFrame:
    """The first ``most`` parent directories of ``priors (site_key, ord, url)`` as ``(site_key, k, seed)``."""
    found = priors.select("site_key", "ord", urls.parent_directory(F.col("url")).alias("seed")).where("seed <> ''").groupBy("site_key", "seed").agg(F.min("ord").alias("o"))
    w = Window.partitionBy("site_key").orderBy("o", "seed")
    return found.withColumn("k", F.row_number().over(w) - 1000).where(F.col("k") <= most - 1000).select("site_key", "seed", "k")


VISITED = "site_key string, url string, seed string, depth int, visit int"


def _visit(site: pd.DataFrame) -> pd.DataFrame:
    """The order in which a site's pages are visited, from its seeds and links alone.

    ``best`` holds what is open: for each url the least ``(rank, depth, url, seed)`` that
    led to it. The least of all is visited next, until the budget is spent.
    """
    key, budget = site["site_key"].iloc[0], int(site["budget"].iloc[0])
    onward = {source: list(part[["link", "rank"]].itertuples(index=False, name=None)) for source, part in site[site["rank"] >= 0].groupby("source")}
    best = {url: (1, 0, url, url) for url in site.loc[site["rank"] < 0, "link"] if url}
    visited: dict[str, tuple] = {}
    while best and len(visited) < budget:
        here = min(best.values())
        _, depth, url, seed = here
        visited[url] = (seed, depth)
        del best[url]
        for link, rank in onward.get(url, ()):
            # Index pages start again at depth 0; others lie one level below.
            deeper = 0 if rank == 0 else depth + 1
            if link not in visited and deeper <= MAX_DEPTH:
                found = (rank, deeper, link, seed)
                best[link] = min(best.get(link, found), found)
    rows = [(key, url, seed, depth, k) for k, (url, (seed, depth)) in enumerate(visited.items())]
    return pd.DataFrame(rows, columns=["site_key", "url", "seed", "depth", "visit"]).astype({"depth": "int32", "visit": "int32"})


def page_links(pages: DataFrame, domains: DataFrame) -> DataFrame:
    """Links of readable pages to their site's own domains, with what a crawl asks of each.

    ``(site_key, url, pos, anchor, link, index, course, listing)``: ``index`` for
    anchors that name an index, ``course`` for course names on course paths.
    """
    allowed = domains.groupBy("site_key").agg(F.collect_set("domain").alias("allowed"))
    ok = (F.col("status") == 200) & (F.length("text") > 0)
    raw = pages.select("site_key", urls.clean_url(F.col("url")).alias("url"), "status", F.when(ok, html.anchors(F.col("text"))).alias("anchors"), F.coalesce("final_url", "url").alias("base"))
    raw = one_a_url(raw, "site_key", "url").where("anchors is not null").select("site_key", "url", "base", F.posexplode("anchors").alias("pos", "a"))
    found = raw.select("site_key", "url", "pos", F.col("a.text").alias("anchor"), urls.clean_url(urls.resolve(F.col("base"), F.col("a.href"))).alias("link")).where("link <> ''")
    found = found.join(allowed, "site_key").where(F.array_contains("allowed", urls.registrable(urls.netloc_of(F.col("link"))))).drop("allowed")
    path, anchor = urls.path_of(F.col("link")), F.col("anchor")
    return found.withColumns(
        {"index": anchor.rlike(html.INDEX_ANCHOR), "on_path": path.rlike(urls.COURSE_PATH), "listing": path.rlike(urls.LISTING_HINT), "course": path.rlike(urls.COURSE_PATH) & html.looks_like_course_name(anchor)}
    )


def crawl(seeds: DataFrame, pages: DataFrame, domains: DataFrame, budgets: DataFrame) -> DataFrame:
    """Bounded best-first crawl over stored pages.

    ``seeds (site_key, k, seed)``, ``pages (site_key, url, status, final_url,
    text)``, ``domains (site_key, domain)``, ``budgets (site_key, budget)``. Only the
    order of visits depends on what was seen before: it is a grouped map over the
    distinct links ``(page, link, rank)`` of a site, without names or bodies. All else
    is set-wise: candidates are the course links of visited pages, by url and stem,
    with the seed and place of their first appearance, the longest anchor, and
    MAX_PER_URL stems a url. Returns rows of kind ``page`` (visited, in order) and
    ``candidate`` (with the seed that found it).
    """
    links_ = staged(page_links(pages, domains), "links")
    rank = F.when(F.col("index"), 0).when(F.col("listing"), 1).otherwise(2)
    onward = links_.where("index or on_path").groupBy("site_key", F.col("url").alias("source"), "link").agg(F.min(rank).alias("rank"))
    first = seeds.select("site_key", F.lit("").alias("source"), F.col("seed").alias("link"), F.lit(-1).alias("rank"))
    visits = staged(onward.unionByName(first).join(budgets, "site_key").groupBy("site_key").applyInPandas(_visit, VISITED), "visits")

    at = visits.select("site_key", F.col("url").alias("link"), F.col("visit").alias("seen_at"))
    named = links_.where("course").join(visits, ["site_key", "url"]).join(at, ["site_key", "link"], "left")
    # An anchor that names an index, to a page not yet seen, was followed and is no candidate.
    named = named.where(~F.col("index") | F.coalesce(F.col("seen_at") <= F.col("visit"), F.lit(False)))
    place = F.struct("visit", "pos")
    longest = F.struct((-F.length("anchor")).alias("n"), place.alias("place"))
    merged = named.groupBy("site_key", F.col("link").alias("url"), names.variant_stem(F.col("anchor")).alias("stem")).agg(F.min(place).alias("o"), F.min_by("seed", place).alias("seed"), F.min_by("anchor", longest).alias("name"))
    kept = cap_per_url(merged.withColumn("ord", F.col("o")), "site_key")
    numbered = kept.withColumn("ord", F.row_number().over(Window.partitionBy("site_key").orderBy("o")) - 1)
    candidates = numbered.select("site_key", F.lit("candidate").alias("kind"), "ord", "name", "url", "seed", F.lit(None).cast("int").alias("depth"))
    return visits.select("site_key", F.lit("page").alias("kind"), F.col("visit").alias("ord"), F.lit(None).cast("string").alias("name"), "url", "seed", "depth").unionByName(candidates)


def seed_yield(crawled: DataFrame, seeds: DataFrame) -> DataFrame:
    """Candidates that each seed found first; seeds without any count 0."""
    found = crawled.where("kind = 'candidate'").groupBy("site_key", "seed").agg(F.count("*").alias("n"))
    return seeds.select("site_key", "seed").distinct().join(found, ["site_key", "seed"], "left").fillna(0, ["n"])


def harvest_prior(priors: DataFrame, pages: DataFrame, domains: DataFrame, most: int = MAX_PRIOR) -> DataFrame:
    """Candidates named by the pages that earlier urls ``(site_key, ord, url)`` show."""
    w = Window.partitionBy("site_key").orderBy("ord")
    listed = priors.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    listed = listed.select("site_key", "ord", urls.clean_url(F.col("url")).alias("url")).where("url <> ''").withColumn("domain", urls.registrable(urls.netloc_of(F.col("url"))))
    heading = html.page_heading(F.col("text"))
    said = pages.where("status = 200 and length(text) > 0").select(urls.clean_url(F.col("url")).alias("url"), F.when(heading != "", heading).otherwise(html.page_title(F.col("text"))).alias("name"))
    named = listed.join(domains, ["site_key", "domain"], "left_semi").join(one_a_url(said), "url").select("site_key", "ord", "url", "name").where(html.looks_like_course_name(F.col("name")))
    level = F.coalesce(urls.level_from_url(F.col("url")), names.level_of(F.col("name")))
    return merge_candidates(named.select("site_key", "ord", "url", "name", level.alias("level"), F.lit("prior").alias("source")), "site_key")


def harvest_sitemaps(sites: DataFrame, pages: DataFrame, domains: DataFrame, most: int = MAX_SITEMAPS) -> DataFrame:
    """Candidates of sitemaps, indexes expanded level by level, ``most`` documents a site in all.

    Documents are read in the order in which they are named, an index's before those
    that it names; expansion ends when no site has an unread document and budget left.
    """
    base = F.regexp_replace(F.col("website"), r"^([a-z]+://[^/]+).*$", "$1")
    usual = F.array(F.concat(base, F.lit("/sitemap.xml")), F.concat(base, F.lit("/sitemap_index.xml")))
    text, found = F.col("text"), pages.where("status = 200 and length(text) > 0")
    maps = one_a_url(found.select("url", F.contains(F.lower(text), F.lit("<sitemapindex")).alias("index"), html.sitemap_locs(text).alias("locs"), html.robots_sitemaps(text).alias("named")).where("size(locs) > 0 or size(named) > 0"))
    maps = staged(maps, "sitemaps")
    robots = sites.select("site_key", F.concat(base, F.lit("/robots.txt")).alias("url"), usual.alias("usual")).join(maps.select("url", "named"), "url", "left")
    todo = robots.select("site_key", F.posexplode(F.concat(F.coalesce("named", F.array().cast("array<string>")), F.col("usual"))).alias("o", "url"))
    level, out = todo.groupBy("site_key", "url").agg(F.min("o").cast("string").alias("o")), None
    level = level.withColumn("o", F.lpad("o", 8, "0"))
    known, left = None, sites.select("site_key", F.lit(most).alias("room"))
    while True:
        w = Window.partitionBy("site_key").orderBy("o", "url")
        chosen = staged(level.join(left, "site_key").withColumn("_n", F.row_number().over(w)).where("_n <= room"), "level")
        if chosen.isEmpty():
            break
        left = staged(left.join(chosen.groupBy("site_key").agg(F.count("*").alias("read")), "site_key", "left").select("site_key", (F.col("room") - F.coalesce("read", F.lit(0))).alias("room")).where("room > 0"), "left")
        known = chosen.select("site_key", "url") if known is None else known.union(chosen.select("site_key", "url"))
        locs = chosen.join(maps, "url").select("site_key", "index", "o", F.posexplode("locs").alias("p", "url"))
        nth = F.concat_ws("/", "o", F.lpad(F.col("p").cast("string"), 8, "0"))
        pages_of = locs.where("not index").select("site_key", nth.alias("o"), urls.clean_url(F.col("url")).alias("url"))
        out = pages_of if out is None else out.union(pages_of)
        level = locs.where("index").groupBy("site_key", "url").agg(F.min(nth).alias("o")).join(known, ["site_key", "url"], "left_anti")
    if out is None:
        out = level.select("site_key", "o", "url").where("false")
    named = out.where("url <> ''").withColumn("domain", urls.registrable(urls.netloc_of(F.col("url")))).join(domains, ["site_key", "domain"], "left_semi")
    named = named.where(urls.path_of(F.col("url")).rlike(urls.COURSE_PATH)).withColumn("name", urls.slug_to_name(F.col("url"))).where(html.looks_like_course_name(F.col("name")))
    first = named.groupBy("site_key", "url").agg(F.min_by("name", "o").alias("name"), F.min("o").alias("o"))
    w = Window.partitionBy("site_key").orderBy("o")
    return first.select("site_key", "url", "name", urls.level_from_url(F.col("url")).alias("level"), F.lit("sitemap").alias("source"), F.row_number().over(w).alias("ord"))


def json_objects(document) -> Iterator[dict]:
    """All objects of a JSON document in document order, however deep."""
    waiting = [document]
    while waiting:
        node = waiting.pop()
        if isinstance(node, dict):
            yield node
        if isinstance(node, (dict, list)):
            waiting.extend(reversed(node.values() if isinstance(node, dict) else node))


def _named_link(node: dict) -> dict[str, str] | None:
    # An empty name keeps its place in the order; it is ruled out where names are judged.
    name = next((str(node[k]) for k in NAME_KEYS if isinstance(node.get(k), (str, int))), None)
    href = next((node[k] for k in URL_KEYS if isinstance(node.get(k), str)), "")
    return {"name": name, "href": href} if name is not None and href else None


def _json_names(bodies: pd.Series) -> pd.Series:
    def of(body: str | None) -> list[dict[str, str]]:
        try:
            return [x for x in map(_named_link, json_objects(json.loads(body or ""))) if x]
        except (ValueError, RecursionError):
            return []

    return bodies.map(of)


def json_candidates(documents: DataFrame, *keep: str, body: str = "text", url: str = "url") -> DataFrame:
    """``(keep..., ord, name, url, level, source)`` of every object with a name and a link, in
    document order; of equal urls the first. A body that is no JSON has none."""
    walk = F.pandas_udf(_json_names, JSON_NAMES)
    return _named_candidates(documents.select(*keep, F.col(url).alias("_base"), walk(F.col(body)).alias("named")), *keep, url="_base")


JSON_NAMES = "array<struct<name:string,href:string>>"


def _named_candidates(documents: DataFrame, *keep: str, url: str = "url") -> DataFrame:
    found = documents.select(*keep, F.col(url).alias("_base"), F.posexplode("named").alias("ord", "c"))
    named = found.select(*keep, "ord", F.trim("c.name").alias("name"), urls.clean_url(urls.resolve(F.col("_base"), F.col("c.href"))).alias("url"))
    named = named.where((F.col("url") != "") & html.looks_like_course_name(F.col("name")))
    first = named.groupBy(*keep, "url").agg(F.min_by("name", "ord").alias("name"), F.min("ord").alias("ord"))
    return first.select(*keep, "ord", "name", "url", F.coalesce(urls.level_from_url(F.col("url")), names.level_of(F.col("name"))).alias("level"), F.lit("json").alias("source"))


def harvest_json(seeds: DataFrame, pages: DataFrame, domains: DataFrame | None = None) -> DataFrame:
    """Candidates of the endpoints that a site's first seeds name."""
    walk = F.pandas_udf(_json_names, JSON_NAMES)
    body = pages.where("status = 200 and length(text) > 0").select(urls.clean_url(F.col("url")).alias("url"), "status", F.coalesce("final_url", "url").alias("final_url"), "text")
    w = Window.partitionBy("site_key").orderBy("k", "seed")
    few = seeds.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= MAX_JSON_SEEDS)
    hinted = one_a_url(body.select("url", "status", "final_url", html.json_hints(F.col("text")).alias("paths")).where("size(paths) > 0"))
    hints = few.join(hinted, few["seed"] == hinted["url"]).select("site_key", "k", "final_url", F.posexplode("paths").alias("p", "path"))
    points = hints.select("site_key", F.struct("k", "p").alias("o"), urls.clean_url(urls.resolve(F.col("final_url"), F.col("path"))).alias("url")).where("url <> ''").groupBy("site_key", "url").agg(F.min("o").alias("o"))
    points = points.withColumn("_n", F.row_number().over(Window.partitionBy("site_key").orderBy("o"))).where(F.col("_n") <= MAX_ENDPOINTS)
    # Endpoints are few: their bodies are picked out first and parsed where they lie.
    wanted = body.join(points.select("url").distinct(), "url", "left_semi").select("url", "status", walk("text").alias("named"))
    found = _named_candidates(points.select("site_key", "url").join(one_a_url(wanted), "url"), "site_key")
    if domains is None:
        return found
    return found.withColumn("domain", urls.registrable(urls.netloc_of(F.col("url")))).join(domains, ["site_key", "domain"], "left_semi").drop("domain")


CANDIDATE = ("site_key", "ord", "name", "url", "level", "source")


def build_catalogs(sites: DataFrame, pages: DataFrame, priors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The extraction ladder over stored pages: ``(candidates, catalogs)``.

    ``sites``: site_key, website, institution, expected_rows; ``pages``: site_key,
    url, status, final_url, text; ``priors``: site_key, ord, url. Listings and
    prior urls for all sites, sitemaps and then JSON endpoints for those that
    are still unhealthy, each rung as one set-wise stage.
    """
    seeds, probes = find_seeds(sites, pages)
    parents = prior_parents(priors)
    seeds = seeds.unionByName(parents).groupBy("site_key", "seed").agg(F.min("k").alias("k"))
    domains = seeds.select("site_key", urls.registrable(urls.netloc_of(F.col("seed"))).alias("domain")).union(
        sites.select("site_key", urls.registrable(urls.netloc_of(F.col("website"))))
    )
    domains = domains.where("domain <> ''").distinct()
    budgets = sites.select("site_key", page_budget(F.col("expected_rows")).alias("budget"))
    # What several rungs read is written, and so is what each rung leaves: plans stay small.
    seeds, domains = staged(seeds, "seeds"), staged(domains, "domains")
    crawled = staged(crawl(seeds, pages, domains, budgets), "crawled")
    level = F.coalesce(urls.level_from_url(F.col("url")), names.level_of(F.col("name")))
    listing = crawled.where("kind = 'candidate'").select("site_key", F.col("ord").cast("long").alias("ord"), "name", "url", level.alias("level"), F.lit("listing").alias("source"))
    prior = harvest_prior(priors, pages, domains)
    shift = lambda df, by: df.select("site_key", (F.col("ord").cast("long") + by).alias("ord"), "name", "url", "level", "source")

    def absorb(df: DataFrame) -> DataFrame:
        return drop_institution_names(df.join(sites.select("site_key", "institution"), "site_key"), "site_key").select(*CANDIDATE, "stem", "institution")

    have = staged(absorb(listing.unionByName(shift(prior, 1_000_000))), "candidates")
    expected = sites.select("site_key", "expected_rows")
    for source, by, harvest in (("sitemap", 2_000_000, lambda s: harvest_sitemaps(s, pages, domains)), ("json", 3_000_000, lambda s: harvest_json(seeds.join(s.select("site_key"), "site_key", "left_semi"), pages, domains))):
        weak = staged(sites.join(extraction_health(have, expected).where(~F.col("healthy")).select("site_key"), "site_key", "left_semi"), "weak")
        have = staged(absorb(have.select(*CANDIDATE).unionByName(shift(harvest(weak), by))), "candidates")
    health = extraction_health(have, expected)
    by_source = have.groupBy("site_key").agg(*[F.count_if(F.col("source") == s).alias(f"n_{s}") for s in SOURCE_RANK])
    own = crawled.where("kind = 'page'").join(pages.select("site_key", urls.clean_url(F.col("url")).alias("url"), "status"), ["site_key", "url"], "left")
    primary = own.join(sites.select("site_key", urls.domain_of(F.col("website")).alias("host")), "site_key").where(urls.domain_of(F.col("url")) == F.col("host"))
    verdicts = probe_verdicts(probes, "site_key").select("site_key", F.col("verdict").alias("access"))
    refusing = probe_verdicts(probes.unionByName(status_histogram(primary, "site_key")).groupBy("site_key", "status").agg(F.sum("n").alias("n")), "site_key").select("site_key", "refusing")
    out = health.join(by_source, "site_key", "left").join(verdicts, "site_key", "left").join(refusing, "site_key", "left")
    out = out.join(own.groupBy("site_key").agg(F.count("*").alias("pages_fetched")), "site_key", "left").join(seeds.groupBy("site_key").agg(F.count("*").alias("seeds")), "site_key", "left")
    out = out.join(sites.select("site_key", "website", "institution"), "site_key")
    access = F.when(F.coalesce("refusing", F.lit(False)), "blocked").otherwise(F.coalesce("access", F.lit("")))
    reason = (
        F.when(F.coalesce("website", F.lit("")) == "", "no_website")
        .when(F.coalesce("seeds", F.lit(0)) == 0, F.when(access != "", access).otherwise("no_hub"))
        .when(F.col("healthy"), "")
        .when(access != "", access)
        .when(F.col("candidates") < MIN_CANDIDATES, "no_candidates")
        .otherwise("thin")
    )
    named = F.when(F.coalesce("seeds", F.lit(0)) == 0, "none").otherwise(
        F.concat(F.when(F.coalesce("n_sitemap", F.lit(0)) > 0, "listing+sitemap").when(F.coalesce("n_prior", F.lit(0)) > 0, "listing+prior").otherwise("listing"), F.when(F.coalesce("n_json", F.lit(0)) > 0, "+json").otherwise(""))
    )
    catalogs = out.select(
        "site_key", "institution", "candidates", "healthy", named.alias("strategy"), reason.alias("failure_reason"),
        F.coalesce("pages_fetched", F.lit(0)).alias("pages_fetched"), F.lit(SCHEMA_VERSION).alias("schema_version"),
    )
    return have.drop("institution"), staged(catalogs, "catalogs")
