"""Records of runs: identifiers, tables of runs, sites and rows, summaries, pruning."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions import urls
from lodestone.sources.tables import upsert

RUNS = "run_id string, started string, finished string, input_path string, args string, rows long, filled long"


def now_iso() -> str:
    """UTC, to the second."""
    return datetime.now(UTC).isoformat(timespec="seconds")


def new_run_id() -> str:
    """A run's name, which sorts by time: date and time to the second, then six random hex digits."""
    return f"{datetime.now(UTC):%Y-%m-%dT%H-%M-%SZ}-{uuid.uuid4().hex[:6]}"


def start_run(spark: SparkSession, run_id: str, input_path: str, args: dict) -> DataFrame:
    """The record of a run that begins, to be upserted by ``run_id``."""
    return spark.createDataFrame([(run_id, now_iso(), None, input_path, json.dumps(args, default=str), None, None)], RUNS)


def finish_run(runs: DataFrame, run_id: str, results: DataFrame) -> DataFrame:
    """``runs`` with the end and the headline counts of one of them."""
    n = results.agg(F.count("*").alias("_rows"), F.count_if(F.col("url") != "").alias("_filled"))
    mine = F.col("run_id") == run_id
    out = runs.crossJoin(F.broadcast(n))  # One row of counts.
    ended = {"finished": F.lit(now_iso()), "rows": F.col("_rows"), "filled": F.col("_filled")}
    return out.withColumns({c: F.when(mine, v).otherwise(F.col(c)) for c, v in ended.items()}).drop("_rows", "_filled")


def site_records(sites: DataFrame, run_id: str) -> DataFrame:
    """Sites as last seen, to be upserted by ``site_key``."""
    return sites.select("site_key", F.col("institution").alias("display_name"), "website", F.lit(run_id).alias("last_run"))


def row_records(results: DataFrame, rows: DataFrame, run_id: str) -> DataFrame:
    """One outcome a row and run, to be upserted by ``(course_id, run_id)``; numbers of unfilled rows are null."""
    own = rows.select("site_key", "id", F.col("flags").alias("_row_flags"))
    df = results.join(own, ["site_key", "id"], "left")
    filled = F.col("url") != ""
    live = F.col("live_score") if "live_score" in results.columns else F.lit(None).cast("double")
    none = F.array().cast("array<string>")
    return df.select(
        F.col("id").alias("course_id"), F.lit(run_id).alias("run_id"), "site_key", F.nullif("url", F.lit("")).alias("url"), F.when(filled, F.col("score")).alias("score"),
        F.when(filled, F.col("margin")).alias("margin"), live.alias("live_score"), "status", F.array_join(F.concat(F.coalesce("_row_flags", none), F.coalesce("flags", none)), ";").alias("flags"),
    )


def record(old: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or replace by key: repeated recording of a run changes nothing twice."""
    return new if old is None else upsert(old, new, keys)


def match_summary(results: DataFrame, *by: str) -> DataFrame:
    """Rows, filled rows, refusals, share groups and the rows in them, for all rows or each ``by``."""
    held = F.when(F.col("url") != "", F.col("url"))
    n = results.groupBy(*by, held.alias("_u")).agg(F.count("*").alias("n"), F.count_if(F.exists("flags", lambda f: f.startswith("share_denied"))).alias("d"))
    shared = F.col("_u").isNotNull() & (F.col("n") > 1)
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    return n.groupBy(*by).agg(
        total(F.col("n"), "rows"), total(F.when(F.col("_u").isNotNull(), F.col("n")), "filled"), total(F.col("d"), "share_denied"),
        F.count_if(shared).alias("share_groups"), total(F.when(shared, F.col("n")), "rows_sharing"),
    )


def level_counts(candidates: DataFrame, *by: str) -> DataFrame:
    return candidates.groupBy(*by, F.coalesce("level", F.lit("None")).alias("level")).agg(F.count("*").alias("n"))


def host_counts(candidates: DataFrame, *by: str, most: int = 8) -> DataFrame:
    """Candidates of each host, the ``most`` largest for each ``by``."""
    n = candidates.groupBy(*by, F.lower(urls.netloc_of(F.col("url"))).alias("host")).agg(F.count("*").alias("n"))
    if not by:
        return n.orderBy(F.desc("n"), "host").limit(most)
    return n.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "host"))).where(F.col("_k") <= most).drop("_k")


def final_order(results: DataFrame) -> DataFrame:
    """Delivered order: institution, name, id; a range sort, not one task."""
    return results.orderBy("institution_name", "name", "id")


def prune_runs(runs: DataFrame, keep: int) -> DataFrame:
    """Runs that stay: the newest ``keep`` by start, all of them for 0."""
    return runs if keep <= 0 else runs.join(runs.orderBy(F.desc("started"), F.desc("run_id")).limit(keep).select("run_id"), "run_id", "left_semi")
