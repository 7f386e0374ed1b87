"""Ingest, repair, history, packing, catalogues, reports, streaming."""

import csv

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestone.operators import catalog, history, ingest, packing, reports, search
from lodestone.plans import catalogue, pipeline
from lodestone.sources import tables
from lodestone.streaming import pages as stream


def test_ragged_lines_are_repaired(spark, tmp_path):
    good = "1,Law,Alpha Uni,,,,,,https://www.alpha.edu,,"
    also = "2,Art,alpha uni,,,,,,https://www.alpha.edu,,"
    split_name = "3,Graduate (Economics, Arts and Music),Alpha Uni,,,,,,https://www.alpha.edu,,"
    by_host = "4,Master (Visual, Arts),,,https://alpha.edu/x"
    sound = "5,Journalism (Politics BA,Alpha Uni,,,,,,https://www.alpha.edu,,"
    (tmp_path / "s.csv").write_text("\n".join([good, also, split_name, by_host, sound]) + "\n")
    rows = {r["id"]: r for r in ingest.legacy_rows(tables.read_lines(spark, str(tmp_path / "s.csv"))).collect()}
    assert rows["3"]["name"] == "Graduate (Economics, Arts and Music)" and rows["3"]["institution_name"] == "Alpha Uni"
    assert rows["3"]["flags"][0] == "malformed_row_repaired" and rows["3"]["website"] == "https://www.alpha.edu"
    assert rows["4"]["name"] == "Master (Visual, Arts)" and rows["4"]["institution_name"] == "alpha uni"
    assert rows["5"]["flags"] == ["truncated_name"] and rows["1"]["flags"] == []


def test_lines_keep_every_field(spark, tmp_path):
    lines = ["\ufeffid,name", ",".join(f"f{k}" for k in range(40)) + ",,", '1,"a, ""b"" c"d,,"', " , ,\t", "", ",x", '"open, to the end', 'a"b,c']
    (tmp_path / "r.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    want = [next(csv.reader([line.removeprefix("\ufeff")])) for line in lines if line.strip(" ,\t")]
    assert [r["fields"] for r in tables.read_lines(spark, str(tmp_path / "r.csv")).orderBy("ord").collect()] == want
    (tmp_path / "t.csv").write_text("id,name\n\u00a0 1\t,\u2003x y\x1f \n", encoding="utf-8")
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "t.csv")).collect()] == [("1", "x y")]


def test_site_ranking_and_suggestions(spark):
    rows = spark.createDataFrame([("a.uk", "A", []), ("a.uk", "A", []), ("a.uk", "B", []), ("b.uk", "C", []), ("", "D", [])], "site_host string, institution_name string, flags array<string>")
    assert [(r["site_host"], r["rank"]) for r in ingest.site_ranking(rows).orderBy("rank").collect()] == [("a.uk", 1), ("b.uk", 2)]
    assert [tuple(r) for r in ingest.suggestions(rows).select("site_host", "rows", "institution_name").collect()] == [("a.uk", 3, "A"), ("b.uk", 1, "C")]
    assert ingest.keep_institutions(rows, ["zzz"]).isEmpty()


def test_csv_roundtrip(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,name\n1," x ""y"" "\n\n2,\n1,z\n', encoding="utf-8")
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "a.csv")).collect()] == [("1", 'x "y"'), ("2", ""), ("1", "z")]
    assert sorted(tuple(r) for r in tables.read_keyed(spark, str(tmp_path / "a.csv")).collect()) == [("1", "z"), ("2", "")]


def test_history_is_idempotent(spark):
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in history.COLUMNS))
    rows = spark.createDataFrame([("1", "https://a.uk/x/", "confident"), ("2", "", "no_match")], "id string, course_url string, matched_status string")
    once = history.upsert_history(empty, history.observe(rows, "r1", "2026-01-01T00:00:00Z"))
    twice = history.upsert_history(once, history.observe(rows, "r1", "2026-01-01T00:00:00Z"))
    assert once.collect() == twice.collect() and once.count() == 1 and once.first()["last_verified"] is not None
    later = history.observe(spark.createDataFrame([("1", "https://a.uk/y", "probable")], "id string, course_url string, matched_status string"), "r2", "2026-02-01T00:00:00Z")
    assert [r["url"] for r in history.moved(once, later).collect()] == ["https://a.uk/y"]
    both = history.upsert_history(once, later)
    assert [tuple(r) for r in history.drifted(both).collect()] == [("1", 2)]
    sheet = spark.createDataFrame([("1", "https://a.uk/x", "2025-06-24", "matched"), ("3", "https://a.uk/z", "", "")], "id string, course_url string, processed_date string, matched_status string")
    assert history.seed_baseline(both, sheet, "now").count() == 3


def test_packing(spark):
    sites = spark.createDataFrame([(f"s{k}", n, k) for k, n in enumerate([50, 1, 1, 1, 30, 2, 2])], "site string, rows long, ord long")
    got = sorted((r["ord"], r["chunk"]) for r in packing.pack_sites(sites, 3).collect())
    chunks = [c for _, c in got]
    assert chunks == sorted(chunks) and set(chunks) == {0, 1, 2} and chunks[:2] == [0, 1]
    # With more chunks than sites none can be closed without leaving a later one empty.
    assert packing.pack_sites(sites, 20).select("chunk").distinct().count() == 1


def test_probe_verdicts(spark):
    cases = {1: {403: 16}, 2: {404: 16}, 3: {200: 4, 404: 12}, 4: {403: 8, 404: 2}, 5: {403: 7, 404: 3}, 6: {200: 100, 403: 3}}
    df = spark.createDataFrame([(k, s, n) for k, h in cases.items() for s, n in h.items()], "host int, status int, n long")
    got = {r["host"]: (r["verdict"], r["refusing"]) for r in catalog.probe_verdicts(df, "host").collect()}
    assert got == {1: ("blocked", True), 2: ("no_hub", False), 3: ("", False), 4: ("blocked", True), 5: ("no_hub", True), 6: ("", False)}


def test_budget_and_health(spark):
    df = spark.createDataFrame([(5,), (4899,), (-5,)], "n int")
    assert [r[0] for r in df.select(catalog.page_budget(F.col("n"))).collect()] == [40, 400, 40]
    health = spark.createDataFrame([(398, 456), (13, 224), (2, 2)], "c int, e int").select(catalog.healthy(F.col("c"), F.col("e")))
    assert [r[0] for r in health.collect()] == [True, False, False]


def test_merge_prefers_source_then_length_then_order(spark):
    rows = [("s", "Law", "u", None, "prior", 1), ("s", "Law BA", "u", None, "listing", 2), ("s", "Law BA (Hons)", "u", None, "listing", 3), ("s", "Art", "u", None, "listing", 4)]
    df = spark.createDataFrame(rows, "site_key string, name string, url string, level string, source string, ord long")
    got = sorted((r["ord"], r["name"], r["source"]) for r in catalog.merge_candidates(df, "site_key").collect())
    assert got == [(1, "Law BA (Hons)", "listing"), (4, "Art", "listing")]


def _pages(spark):
    course = lambda n: f"<html><title>{n}</title><h1>{n}</h1></html>"
    names = ["Fine Art BA", "Marine Law LLB", "Data Science BSc", "Modern Music BA", "Equine Science BSc", "Deep History BA"]
    index = "".join(f"<a href='/courses/{n.lower().replace(' ', '-')}'>{n}</a>" for n in names)
    rows = [("https://www.a.edu/courses", 200, "https://www.a.edu/courses", f"<h1>Courses</h1>{index}<a href='/about'>About us</a>")]
    rows += [(f"https://www.a.edu/courses/{n.lower().replace(' ', '-')}", 200, f"https://www.a.edu/courses/{n.lower().replace(' ', '-')}", course(n)) for n in names]
    rows += [("https://www.b.edu/study", 403, "https://www.b.edu/study", "")]
    return spark.createDataFrame(rows, "url string, status int, final_url string, text string"), names


def test_phase1_end_to_end(spark):
    pages, names = _pages(spark)
    sheet = [(k, str(k), n + " (Hons)", "Alpha", "https://www.a.edu") for k, n in enumerate(names)] + [(8, "8", "Fine Art BA (Hons)", "Alpha", "http://www.a.edu"), (9, "9", "Law LLB", "Beta", "https://www.b.edu")]
    rows = ingest.course_rows(spark.createDataFrame(sheet, "ord long, id string, name string, institution_name string, website string"))
    results, catalogs, candidates = pipeline.phase1(rows, pages)
    got = {r["id"]: r for r in results.collect()}
    assert len(got) == 8 and all(got[str(k)]["status"] == "confident" for k in range(6))
    assert got["8"]["url"] == got["0"]["url"] and "shared_with_duplicate_row" in got["8"]["flags"]
    assert got["9"]["status"] == "no_catalog"
    health = {r["site_key"]: r for r in catalogs.collect()}
    assert health["a.edu"]["healthy"] and health["b.edu"]["failure_reason"] == "blocked"
    assert reports.filled_csv(results, rows.withColumnRenamed("site_host", "site_key")).count() == 8
    assert "## Status" in reports.coverage_markdown(results, catalogs)


def test_json_candidates(spark):
    body = '{"items": [{"title": "Fine Art", "url": "/c/a", "more": {"name": "Law Degree", "link": "/c/b"}}, {"title": "Fine Art 2", "url": "/c/a"}], "n": 1}'
    df = spark.createDataFrame([("https://a.edu/api", body), ("https://a.edu/x", "no json")], "url string, text string")
    assert sorted((r["name"], r["url"]) for r in catalog.json_candidates(df).collect()) == [("Fine Art", "https://a.edu/c/a"), ("Law Degree", "https://a.edu/c/b")]


def test_json_walk_equals_its_sql(spark, tmp_path):
    titles = ["Law LLB", "Master of Laws LLM", "", "Fine Art", "Home"]
    rows = [(k, f"https://a.edu/{'ug/' * (k == 1)}p{k}", f"<title>{t}</title>") for k, t in enumerate(titles)] + [(9, "https://a.edu/x/y", "<p>none</p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = catalogue.json_walk(spark, str(tmp_path)).select("page_id", "ord", "name", "url", "level", "source").collect()
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        wanted = db.execute(f"SELECT page_id, ord, name, url, level, source FROM ({catalogue.ORACLES['json_walk']})").fetchall()
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == sorted(wanted, key=lambda r: r[:2]) and len(wanted) == 9
    assert {r["page_id"]: r["level"] for r in got if r["ord"] == 0} == {0: None, 1: "ug", 3: None}


def test_sitemaps(spark):
    sites = spark.createDataFrame([("a.edu", "https://www.a.edu", "Alpha", 5)], "site_key string, website string, institution string, expected_rows int")
    index = "<sitemapindex><loc> https://www.a.edu/s1.xml </loc></sitemapindex>"
    pages = spark.createDataFrame([("https://www.a.edu/sitemap.xml", 200, index), ("https://www.a.edu/s1.xml", 200, "<loc>https://www.a.edu/courses/fine-art</loc><loc>https://www.a.edu/news/x</loc>")], "url string, status int, text string")
    domains = spark.createDataFrame([("a.edu", "a.edu")], "site_key string, domain string")
    assert [(r["name"], r["source"]) for r in catalog.harvest_sitemaps(sites, pages, domains).collect()] == [("fine art", "sitemap")]


def test_search(spark):
    df = spark.createDataFrame([("", "truncated_name", "A  b"), ("u", "", "c"), ("", "x;year_level_not_course", "d")], "u string, f string, n string")
    assert [r[0] for r in df.select(search.is_searchable(F.col("u"), F.col("f"))).collect()] == [True, False, False]
    assert df.select(search.build_query(F.col("n"), F.lit(""), F.lit("a.edu"))).first()[0] == '"A b" site:a.edu'


def test_stream_keeps_newest_page(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('{"url":"https://a.uk/x/","status":200,"text":"<p>old</p>","fetched":"2026-01-01T00:00:00Z"}\n{"url":"https://a.uk/x","status":200,"text":"<p>new</p>","fetched":"2026-01-02T00:00:00Z"}\n')
    q = stream.keep_pages(spark, str(src), str(tmp_path / "t"), str(tmp_path / "c"))
    q.awaitTermination(60)
    assert [(r["url"], r["text"]) for r in stream.read_pages(spark, str(tmp_path / "t")).collect()] == [("https://a.uk/x", "<p>new</p>")]
