"""Whole sites into chunks, and checks of merged chunks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_starts(sizes: np.ndarray, chunks: int) -> list[int]:
    """Where the chunks of an ordered run of sites begin.

    With the sizes summed up, a chunk reaches to the last site that keeps it within
    an equal share of the rows from its start on, over the chunks still to fill; the
    next one begins there, if enough sites are left to give each later chunk one.
    """
    reach = np.concatenate([[0], np.cumsum(sizes)])
    starts = [0]
    for still in range(chunks, 1, -1):
        here = reach[starts[-1]]
        # In whole numbers: rows * still <= rows left is "within an equal share".
        over = int(np.searchsorted((reach - here) * still, reach[-1] - here, "right")) - 1
        begin = max(over, int(np.searchsorted(reach, here, "right")))
        if len(sizes) - begin < max(still - 1, 1):
            break
        starts.append(begin)
    return starts


def pack_sites(sites: DataFrame, chunks: int, site: str = "site", rows: str = "rows", ord_: str = "ord") -> DataFrame:
    """``(site, rows, ord, chunk)``: sites in order into chunks of about equal rows.

    The chunks' starts follow from one narrow number a site, its rows, which the
    driver sums up; a site's chunk is the number of starts at or before its place.
    """
    kept = sites.select(F.col(site).alias(site), F.col(rows).cast("long").alias(rows), F.col(ord_).cast("long").alias(ord_))
    inline = kept.select(ord_, rows).orderBy(ord_).toArrow()
    orders = inline.column(ord_).to_numpy()
    firsts = [int(orders[k]) for k in chunk_starts(inline.column(rows).to_numpy(), chunks)] if len(orders) else []
    return kept.withColumn("chunk", F.size(F.filter(F.array(*map(F.lit, firsts)).cast("array<long>"), lambda x: x <= F.col(ord_))) - 1)


def align(rows: DataFrame, source: DataFrame, key: str = "id", ord_: str = "ord") -> DataFrame:
    """Rows next to the source record of the same place; another length or id is an error."""
    both = rows.select(ord_, key).join(source.select(ord_, F.col(key).alias("_other")), ord_, "full")
    wrong = both.where(~F.col(key).eqNullSafe(F.col("_other"))).take(1)
    if wrong:
        raise ValueError(f"rows and source do not align: {wrong[0].asDict()}")
    return rows.join(source.drop(key), ord_)


def duplicate_ids(df: DataFrame, key: str = "id") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def missing_keys(expected: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Keys that are expected and not there."""
    return expected.select(key).distinct().join(have.select(key).distinct(), key, "left_anti")


def check_merge(merged: DataFrame, source_rows: int, no_website_rows: int, key: str = "id") -> DataFrame:
    """One row: rows, what the manifest wants, repeated ids."""
    repeated = duplicate_ids(merged, key).agg(F.count("*").alias("duplicate_ids"))
    return merged.agg(F.count("*").alias("rows")).join(repeated).select("rows", F.lit(source_rows - no_website_rows).cast("long").alias("wanted"), "duplicate_ids", (F.col("rows") == source_rows - no_website_rows).alias("complete"))
