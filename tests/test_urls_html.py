"""Urls, hosts and page bodies."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from lodestone.functions import html, urls


def check(spark, pairs, make):
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    got = [(r["a"], r["v"]) for r in df.withColumn("v", make(F.col("a")).cast("string")).orderBy("k").collect()]
    assert got == [(a, b) for a, b in pairs]


def test_clean_url(spark):
    check(
        spark,
        [
            ("https://a.ac.uk/courses/x/?utm_source=q&page=2#top", "https://a.ac.uk/courses/x?page=2"),
            ("https://a.ac.uk/x/?term=2026-27", "https://a.ac.uk/x"),
            ("https://a.ac.uk", "https://a.ac.uk/"),
            (" https://A.ac.uk/x ", "https://A.ac.uk/x"),
            ("mailto:a@b.c", ""),
            ("https://a.uk/s?q=a%20b&e=&x=~*", "https://a.uk/s?q=a+b&x=~%2A"),
            (None, ""),
        ],
        urls.clean_url,
    )


def test_registrable(spark):
    pairs = [("www.aber.ac.uk", "aber.ac.uk"), ("courses.aber.ac.uk", "aber.ac.uk"), ("barkly.vic.edu.au", "barkly.vic.edu.au"), ("x.barkly.vic.edu.au", "barkly.vic.edu.au"), ("www.abc.de", "www.abc.de"), ("a.b.example.com", "example.com"), ("localhost", "localhost"), ("", "")]
    check(spark, pairs, urls.registrable)


def test_level_specificity_slug(spark):
    check(spark, [("https://a.uk/undergraduate/x", "ug"), ("https://a.uk/phd", "pg"), ("https://a.uk/x", None)], urls.level_from_url)
    check(spark, [("https://a.uk/courses/x", "1.0"), ("https://a.uk/undergraduate-subjects/art/", "0.82"), ("https://a.uk/x", "0.9"), ("https://a.uk/x/y", "1.0")], urls.url_specificity)
    check(spark, [("https://a.uk/courses/data-science-degree/", "data science"), ("https://a.uk/a_b.html", "a b"), ("https://a.uk", "")], urls.slug_to_name)


def test_change_classes(spark):
    rows = [("", "", "none"), ("", "https://a.uk/x", "added"), ("https://a.uk/x", "", "dropped"), ("http://www.a.uk/x/", "https://a.uk/x#t", "unchanged"), ("https://a.uk/x", "https://a.uk/y", "changed")]
    df = spark.createDataFrame(rows, "p string, f string, w string")
    assert all(r[0] == r[1] for r in df.select(urls.classify_change(F.col("p"), F.col("f")), "w").collect())


def test_resolve(spark):
    pairs = [("/x", "https://a.uk/x"), ("y?z=1", "https://a.uk/d/y?z=1"), ("../y", "https://a.uk/y"), ("//b.uk/z", "https://b.uk/z"), ("http://c.uk", "http://c.uk"), ("#t", "https://a.uk/d/e#t")]
    check(spark, pairs, lambda h: urls.resolve(F.lit("https://a.uk/d/e"), h))


def test_resolve_dot_segments(spark):
    base = "https://a.uk/1/2/3/4/5/6?q=1#f"
    hrefs = ["../../../../../../../x", "../../../../x/", "./y/./z", "..", ".", "/a/b/../../../c/./d", "/a/..", "m//n/../o?u=/../v", "#t", "?z", "/p//q", "a/../../b#/../c", "../2/..", "g;x=1/../y"]
    check(spark, [(h, urljoin(base, h)) for h in hrefs], lambda h: urls.resolve(F.lit(base), h))


def test_soft_404(spark):
    pairs = [("<title>Error - Page not Found | L</title>", "true"), ("<h2>404 error</h2>", "true"), ("<p>page not found</p>", "false"), ("<title>Law</title>", "false"), ("", "false")]
    check(spark, pairs, html.looks_like_soft_404)


def test_course_names(spark):
    pairs = [("Data Science", "true"), ("MBA", "true"), ("Home", "false"), ("12", "false"), ("Skip to content area", "false"), ("A" * 161, "false"), ("", "false"), ("of", "false")]
    check(spark, pairs, html.looks_like_course_name)


def test_shrink(spark):
    ld = '<script type="application/ld+json">{"a":1}</script>'
    pairs = [("User-agent: *\nSitemap: x", "User-agent: *\nSitemap: x"), (f"<p>a</p>\n <script>x</script><!-- c -->{ld}<style>y</style> b", f"<p>a</p> b{ld}"), (None, None)]
    check(spark, pairs, html.shrink_page)


def test_anchors(spark):
    row = spark.createDataFrame([("<A class=x HREF='/a'>One <b>two</b></A><a href=\"b\">\n c </a>",)], "h string").select(html.anchors(F.col("h"))).first()[0]
    assert [(a["href"], a["text"]) for a in row] == [("/a", "One two"), ("b", "c")]
