"""Run records, stored pages, decoding, robots rules, packing, JSON, sharing and commands."""

import gzip
import json
import random
import re
import zlib

import numpy as np

from lodestone import __main__ as commands
from lodestone.operators import catalog, packing, runs
from lodestone.operators.sharing import Course, Ledger
from lodestone.sources import pagestore, stage


def test_run_records(spark):
    a, b = runs.new_run_id(), runs.new_run_id()
    assert a != b and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d-\d\d-\d\dZ-[0-9a-f]{6}", a) and runs.now_iso().endswith("+00:00")
    begun = runs.record(runs.start_run(spark, "r1", "x.csv", {"limit": 3}), runs.start_run(spark, "r1", "x.csv", {"limit": 4}), ["run_id"])
    results = spark.createDataFrame([("s", "1", "u", 0.9, 0.2, "confident", []), ("s", "2", "u", 0.8, 0.1, "probable", ["x"]), ("s", "3", "", 0.0, 0.0, "no_match", ["share_denied_cap_reached"])], "site_key string, id string, url string, score double, margin double, status string, flags array<string>")
    done = runs.finish_run(begun, "r1", results).collect()
    assert len(done) == 1 and (done[0]["rows"], done[0]["filled"], json.loads(done[0]["args"])) == (3, 2, {"limit": 4}) and done[0]["finished"]
    rows = spark.createDataFrame([("s", "1", ["own"]), ("s", "2", []), ("s", "3", [])], "site_key string, id string, flags array<string>")
    kept = {r["course_id"]: r for r in runs.row_records(results, rows, "r1").collect()}
    assert kept["1"]["flags"] == "own" and kept["3"]["url"] is None and kept["3"]["score"] is None
    assert runs.match_summary(results).first().asDict() == {"rows": 3, "filled": 2, "share_denied": 1, "share_groups": 1, "rows_sharing": 2}
    many = spark.createDataFrame([(f"r{k}", f"2026-01-{k:02}") for k in range(1, 6)], "run_id string, started string")
    assert sorted(r["run_id"] for r in runs.prune_runs(many, 2).collect()) == ["r4", "r5"] and runs.prune_runs(many, 0).count() == 5
    found = spark.createDataFrame([("https://A.edu/x", "ug"), ("https://a.edu/y", None), ("https://b.edu/", "ug")], "url string, level string")
    assert {r["level"]: r["n"] for r in runs.level_counts(found).collect()} == {"ug": 2, "None": 1}
    assert [tuple(r) for r in runs.host_counts(found, most=1).collect()] == [("a.edu", 2)]


def test_stored_pages(spark, tmp_path):
    page = lambda u, t: spark.createDataFrame([(u, 200, u, t)], "url string, status int, final_url string, text string")
    pagestore.write_pages(page("https://a.edu/x", "<p>old</p>").union(page("https://a.edu/y", "<p>y <script>no</script></p>")), str(tmp_path / "p"))
    pagestore.write_pages(page("https://a.edu/x", "<p>new</p>"), str(tmp_path / "p"))
    assert sorted((r["url"], r["text"]) for r in pagestore.read_pages(spark, str(tmp_path / "p")).collect()) == [("https://a.edu/x", "<p>new</p>"), ("https://a.edu/y", "<p>y </p>")]
    wanted = spark.createDataFrame([("https://a.edu/x",), ("https://a.edu/none",)], "url string")
    assert [r["text"] for r in pagestore.read_pages(spark, str(tmp_path / "p"), wanted).collect()] == ["<p>new</p>"]


def test_bodies_are_decoded(spark):
    deflate = zlib.compressobj(9, zlib.DEFLATED, -15)
    rows = [(gzip.compress("é".encode()), None, None), (deflate.compress("ü".encode()) + deflate.flush(), "deflate", ""), ("é".encode("latin-1"), "", "text/html; charset=iso-8859-1; x"), (b"\xff", "gzip", "text/html; charset=nonsense"), (None, None, None)]
    got = pagestore.decoded(spark.createDataFrame(rows, "body binary, content_encoding string, content_type string")).collect()
    assert [r["text"] for r in got] == ["é", "ü", "é", "ÿ", None]


def test_robots(spark):
    files = [("https://a.edu/robots.txt", 200, "User-agent: *\nDisallow: /private"), ("https://b.edu/robots.txt", 200, "<html>not found</html>"), ("https://c.edu/robots.txt", 404, "User-agent: *\nDisallow: /")]
    robots = spark.createDataFrame(files, "url string, status int, text string")
    wanted = spark.createDataFrame([("https://a.edu/private/x",), ("https://A.edu/x",), ("https://b.edu/x",), ("https://c.edu/x",), ("https://d.edu/x",)], "url string")
    got = {r["url"]: r["allowed"] for r in pagestore.allowed_by_robots(wanted, robots, "bot").collect()}
    assert got == {u[0]: u[0] != "https://a.edu/private/x" for u in (r for r in wanted.collect())}


def test_chunks_are_closed_at_their_share():
    rng = random.Random(2)
    for _ in range(500):
        sizes, chunks = [rng.randint(1, 40) for _ in range(rng.randint(1, 25))], rng.randint(1, 9)
        starts = packing.chunk_starts(np.array(sizes), chunks)
        assert starts == sorted(set(starts)) and len(starts) <= chunks
        for k, begin in enumerate(starts):
            still, left = chunks - k, sum(sizes[begin:])
            stop = starts[k + 1] if k + 1 < len(starts) else len(sizes)
            if k + 1 < len(starts):
                # It took all that fits its share (one site at least), and the next site would not fit.
                assert stop == begin + 1 or sum(sizes[begin:stop]) * still <= left
                assert sum(sizes[begin : stop + 1]) * still > left and len(sizes) - stop >= still - 1
        if len(sizes) >= chunks and len(starts) < chunks:
            begin, still = starts[-1], chunks - len(starts) + 1
            assert len(sizes) - begin <= still or all(sum(sizes[begin : k + 1]) * still <= sum(sizes[begin:]) or len(sizes) - k < still - 1 for k in range(begin + 1, len(sizes)))


def test_json_objects_in_document_order():
    deep = {"n": 0}
    for k in range(1, 5000):
        deep = {"n": k, "in": [deep, 1]}
    assert [x["n"] for x in catalog.json_objects(deep)] == list(range(4999, -1, -1))
    assert [x.get("a") for x in catalog.json_objects({"a": 1, "b": {"a": 2, "c": [{"a": 3}]}, "d": [{"a": 4}, "x"]})] == [1, 2, 3, 4]


def test_ledger():
    book = Ledger([("1", "law", ["bachelor"]), ("2", "law", []), ("3", "law", ["masters"]), ("4", "art", []), ("5", "law", ["bachelor"])], 2)
    assert Course("", frozenset()).is_sibling_of(Course("", frozenset())) is False
    assert book.objection("u", "1") is None
    book.move("1", "u")
    assert book.objection("u", "2") is None and book.objection("u", "3") == ("stem_mismatch", "1") == book.objection("u", "4")
    book.move("2", "u")
    assert book.objection("u", "5") == ("cap_reached", "1")
    book.move("1", "v", "u")
    assert book.objection("u", "5") is None and book.holders["v"] == ["1"]


def test_rank_over_all_partitions(spark):
    df = spark.range(0, 1000, numPartitions=7).selectExpr("id", "(id * 7919) % 1000 as x")
    assert all(r["rank"] == r["x"] + 1 for r in stage.ranked(df, "rank", "x").collect())
    assert stage.ranked(df.limit(0), "rank", "x").count() == 0


def test_commands(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(commands, "get_session", lambda master: spark)
    sheet, results = tmp_path / "s.csv", tmp_path / "r.csv"
    sheet.write_text("id,name,institution_name,website,course_url,matched_status\n" + "".join(f"{k},Course {k},Uni {k % 3},https://www.s{k % 3}.edu,https://www.s{k % 3}.edu/{k},matched\n" for k in range(9)))
    results.write_text("id,course_url\n" + "".join(f"{k},https://www.s{k % 3}.edu/{k if k else 'new'}\n" for k in range(10)))
    assert commands.main(["split", "--input", str(sheet), "--chunks", "3", "--out", str(tmp_path / "chunks")]) == 0
    assert len(list((tmp_path / "chunks").glob("chunk=*"))) == 3
    assert commands.main(["backfill", "--results", str(results), "--source", str(sheet), "--out", str(tmp_path / "b")]) == 0
    said = capsys.readouterr().out
    assert "'unchanged': 8" in said and "'changed': 1" in said and "'(not in source sheet)': 1" in said
    part = ["merge", "--parts", str(results), "--out", str(tmp_path / "m"), "--rows"]
    assert commands.main([*part, "10"]) == 0 and commands.main([*part, "11"]) == 1 and commands.main([*part, "11", "--allow-partial"]) == 0
    assert commands.main(["phase1", "--input", str(sheet), "--pages", "x", "--out", "y", "--institution", "nobody"]) == 1
    assert commands.main(["phase1", "--input", str(sheet), "--pages", "x", "--out", "y", "--dry-run", "--limit", "1"]) == 0
