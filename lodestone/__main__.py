"""Commands: ``python -m lodestone phase1|phase2|split|merge|backfill ...``.

Exit codes: 0 done, 1 the input or the result is not as it should be, 2 wrong usage.
"""

from __future__ import annotations

import argparse
import dataclasses
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lodestone.functions import urls
from lodestone.operators import ingest, packing, reports, runs
from lodestone.operators.matching import Thresholds
from lodestone.plans import pipeline
from lodestone.session import get_session
from lodestone.sources import tables


def options() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lodestone", description=__doc__.splitlines()[0])
    top.add_argument("--master", help="Spark master; that of the environment by default")
    sub = top.add_subparsers(dest="command", required=True)
    add = lambda name, text: sub.add_parser(name, help=text)
    one = add("phase1", "match a sheet against stored pages")
    one.add_argument("--input", required=True, help="sheet (CSV)")
    one.add_argument("--pages", required=True, help="stored pages (Parquet: url, status, final_url, text)")
    one.add_argument("--out", required=True, help="folder of the results")
    one.add_argument("--institution", action="append", help="only sites of this institution (repeatable)")
    one.add_argument("--limit", type=int, help="only the largest sites")
    one.add_argument("--no-verify", action="store_true", help="do not hold urls against their pages")
    one.add_argument("--dry-run", action="store_true", help="say what would be done")
    for name in ("confident", "floor", "min-margin"):
        one.add_argument(f"--{name}", type=float)
    two = add("phase2", "weigh results against the sheet's own urls")
    two.add_argument("--results", required=True)
    two.add_argument("--input", required=True)
    two.add_argument("--out", required=True)
    split = add("split", "whole sites into chunks")
    split.add_argument("--input", required=True)
    split.add_argument("--chunks", type=int, default=20)
    split.add_argument("--out", required=True)
    split.add_argument("--report", action="store_true", help="say what would be written")
    merge = add("merge", "unite result chunks and check them")
    merge.add_argument("--parts", nargs="+", required=True)
    merge.add_argument("--rows", type=int, required=True, help="rows of the sheet")
    merge.add_argument("--without-website", type=int, default=0)
    merge.add_argument("--out", required=True)
    merge.add_argument("--allow-partial", action="store_true")
    back = add("backfill", "add provenance columns to results")
    back.add_argument("--results", required=True)
    back.add_argument("--source", required=True)
    back.add_argument("--out", help="without it only the counts are shown")
    return top


def course_rows(spark: SparkSession, path: str):
    return ingest.course_rows(tables.read_csv(spark, path).withColumn("ord", F.monotonically_increasing_id()))


def phase1(spark: SparkSession, args) -> int:
    rows = course_rows(spark, args.input)
    if args.institution:
        all_rows, rows = rows, ingest.keep_institutions(rows, args.institution)
        if rows.isEmpty():
            print(f"no institution matches {args.institution}; try one of:", *(f"{r['rows']:6d}  {r['institution_name']}" for r in ingest.suggestions(all_rows).collect()), sep="\n", file=sys.stderr)
            return 2
    if args.limit is not None:
        rows = rows.join(ingest.site_ranking(rows).where(F.col("rank") <= args.limit).select("site_host"), "site_host", "left_semi")
    summary = ingest.load_summary(rows).first().asDict()
    print(summary)
    if not summary["rows"]:
        print("no rows match", file=sys.stderr)
        return 1
    if args.dry_run:
        return 0
    given = {k: getattr(args, k) for k in ("confident", "floor", "min_margin") if getattr(args, k) is not None}
    run_id = runs.new_run_id()
    begun = runs.start_run(spark, run_id, args.input, vars(args))
    results, catalogs, _ = pipeline.phase1(rows, spark.read.parquet(args.pages), dataclasses.replace(Thresholds(), **given), verified=not args.no_verify)
    keyed = rows.withColumnRenamed("site_host", "site_key")
    catalogs.write.parquet(f"{args.out}/catalogs/run_id={run_id}")
    runs.row_records(results, keyed, run_id).write.parquet(f"{args.out}/row_results/run_id={run_id}")
    runs.finish_run(begun, run_id, results).write.mode("append").parquet(f"{args.out}/runs")
    tables.write_csv(reports.filled_csv(results, keyed), f"{args.out}/courses_filled", ["institution_name", "name", "id"])
    print(reports.coverage_markdown(results, catalogs))
    return 0


def phase2(spark: SparkSession, args) -> int:
    sheet = tables.read_csv(spark, args.input)
    results = tables.read_csv(spark, args.results).withColumn("ord", F.monotonically_increasing_id())
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in pipeline.history.COLUMNS))
    triaged, kept, moved = pipeline.phase2(results, sheet, empty, runs.new_run_id(), runs.now_iso())
    tables.write_csv(triaged, f"{args.out}/courses_triaged", ["ord"])
    kept.write.mode("overwrite").parquet(f"{args.out}/url_history")
    print(pipeline.triage.triage_stats(triaged).first().asDict(), {"moved": moved.count()})
    return 0


def split(spark: SparkSession, args) -> int:
    rows = course_rows(spark, args.input)
    sites = ingest.site_ranking(rows).select(F.col("site_host").alias("site"), "rows", F.col("rank").alias("ord"))
    chunks = packing.pack_sites(sites, args.chunks)
    plan = tables.manifest(chunks, rows.count(), rows.where("site_host = ''").count())
    print(plan)
    if not args.report:
        sheet = tables.read_csv(spark, args.input)
        placed = rows.select("id", F.col("site_host").alias("site")).join(chunks.select("site", "chunk"), "site").select("id", "chunk")
        tables.write_chunks(sheet.join(placed, "id"), args.out)
    return 0


def merge(spark: SparkSession, args) -> int:
    merged = tables.union_chunks([tables.read_csv(spark, p) for p in args.parts])
    check = packing.check_merge(merged, args.rows, args.without_website).first().asDict()
    print(check)
    if check["duplicate_ids"] or not (check["complete"] or args.allow_partial):
        return 1
    tables.write_csv(merged, args.out, ["id"])
    return 0


def backfill(spark: SparkSession, args) -> int:
    source = tables.read_keyed(spark, args.source).select("id", F.trim("course_url").alias("prior_course_url"), F.trim("matched_status").alias("prior_matched_status"))
    own = tables.read_csv(spark, args.results).drop("prior_course_url", "prior_matched_status", "url_change")
    both = own.join(source.withColumn("_known", F.lit(True)), "id", "left").fillna("", ["prior_course_url", "prior_matched_status"])
    done = both.withColumn("url_change", urls.classify_change(F.col("prior_course_url"), F.trim("course_url")))
    counts = {r["url_change"]: r["n"] for r in done.groupBy("url_change").agg(F.count("*").alias("n")).collect()}
    print(counts | {"(not in source sheet)": done.where("_known is null").count()})
    if args.out:
        tables.write_csv(done.drop("_known"), args.out, ["id"])
    return 0


def main(argv: list[str] | None = None) -> int:
    args = options().parse_args(argv)
    return {"phase1": phase1, "phase2": phase2, "split": split, "merge": merge, "backfill": backfill}[args.command](get_session(args.master), args)


if __name__ == "__main__":
    sys.exit(main())
