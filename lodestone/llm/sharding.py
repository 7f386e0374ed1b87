"""Longest-processing-time scheduling of groups onto shards."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import key128, materialise, utf8_bytes

#: Slots of a shard are numbered in so many cells, each sorted by one task.
CELLS = 256
#: Groups of one size are ranked in cells of at most about so many.
RANKED = 1 << 16
#: A group of at least 1 / LARGE of all rows is a large one.
LARGE = 1024


def deal(loads: list[int], size: int, count: int) -> list[int]:
    """How many of ``count`` items of one size a heap of ``loads`` hands to each shard.

    Item by item the least-loaded shard, the lower number on a tie, takes the next
    one: shard j takes its k-th item at load ``loads[j] + k * size``, so the items go
    to the ``count`` smallest of these pairs of load and shard. The highest load that
    is used up whole is found by bisection, not item by item.
    """

    def below(level: int) -> list[int]:
        return [max(0, -(-(level - load) // size)) for load in loads]

    low, high = min(loads), min(loads) + size * count
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if sum(below(middle)) <= count else (low, middle - 1)
    taken = below(low)
    left = count - sum(taken)
    for j, load in enumerate(loads):
        if left and load + taken[j] * size == low:
            taken[j] += 1
            left -= 1
    return taken


def schedule(sizes: Iterable[tuple[int, int]], n_shards: int) -> Iterator[tuple[int, list[int]]]:
    """Longest-processing-time scheduling of ``(size, count)``, largest first.

    Yields each size with the ranks at which the shards' shares end: shard j takes
    the items of ranks ``ends[j - 1] <= rank < ends[j]``.
    """
    loads = [0] * n_shards
    for size, count in sizes:
        ends, before = [], 0
        for j, n in enumerate(deal(loads, size, count)):
            loads[j] += n * size
            before += n
            ends.append(before)
        yield size, ends


def _running_start(counted: DataFrame, by: list[str], cell: str, n: str) -> Column:
    before = Window.partitionBy(*by).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(before), F.lit(0))


def shard(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put all rows into ``n_shards`` shards of near-equal bytes, equal texts together.

    A row's size is its text's UTF-8 bytes plus 8. Groups of equal texts are dealt by
    longest-processing-time: the largest first, each to the least-loaded shard. Only
    sizes decide, so the driver sees the histogram of group sizes, streamed in falling
    order: distinct sizes number at most the root of twice all bytes. Runs of equal
    size pass the heap at once (:func:`deal`); each group then finds its shard by its
    rank among the groups of its size, ranked in hashed cells, so that a size which
    very many groups have is no hot key. The plan is joined by a merge, not broadcast.

    Returns one row per input row: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard`` and ``group_key``. Null texts have size 8, a null checksum and
    are one group; an empty text is another group. Texts of any length count whole.
    Equal and null ids and wholly equal rows each keep a slot of their own. An empty
    table gives no rows. Other columns of ``docs`` are not read.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), (utf8_bytes(text) + 8).alias("size"), F.crc32(text).alias("text_crc32"), key128(text).alias("group_key"))
    # Written with a number for each row, by which equal rows are told apart.
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    spark = docs.sparkSession
    groups = materialise(rows.groupBy("group_key").agg(F.sum("size").alias("g_size"), F.count("*").alias("n")), "groups")

    histogram = materialise(groups.groupBy("g_size").agg(F.count("*").alias("n")), "sizes")
    sizes = ((r["g_size"], r["n"]) for r in histogram.orderBy(F.desc("g_size")).toLocalIterator())
    planned = pa.Table.from_pylist([{"g_size": size, "ends": ends} for size, ends in schedule(sizes, n_shards)], pa.schema([("g_size", pa.int64()), ("ends", pa.list_(pa.int64()))]))
    plan = materialise(spark.createDataFrame(planned), "plan") if planned.num_rows else spark.createDataFrame([], "g_size long, ends array<bigint>")

    total = histogram.agg(F.sum("n")).first()[0] or 0
    placed = groups.withColumn("cell", F.pmod(F.xxhash64("group_key"), F.lit(min(1 + total // RANKED, 4096))))
    cells = placed.groupBy("g_size", "cell").agg(F.count("*").alias("n"))
    starts = cells.select("g_size", "cell", _running_start(cells, ["g_size"], "cell", "n").alias("start")).join(plan.hint("merge"), "g_size")
    nth = F.row_number().over(Window.partitionBy("g_size", "cell").orderBy("group_key"))
    ranked = placed.withColumn("nth", nth).join(starts.hint("merge"), ["g_size", "cell"]).withColumn("rank", F.col("start") + F.col("nth") - 1)
    home = materialise(ranked.select("group_key", "n", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard")), "home")

    # At most LARGE groups hold a share of 1 / LARGE of all rows: those reach their rows by broadcast, the others by a merge.
    large = F.broadcast(home.where(F.col("n") * LARGE >= rows.count()).select("group_key", F.col("shard").alias("own_shard")))
    marked = rows.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(CELLS)).cast("int")).join(large, "group_key", "left")
    small = marked.where("own_shard is null").drop("own_shard").join(home.drop("n").hint("merge"), "group_key")
    dealt = materialise(marked.where("own_shard is not null").withColumnRenamed("own_shard", "shard").unionByName(small), "dealt")
    cells = dealt.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    starts = cells.select("shard", "cell", _running_start(cells, ["shard"], "cell", "n").alias("start"))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "row")
    # One row for each shard and cell: a bound that no input changes.
    return (
        dealt.withColumn("nth", F.row_number().over(within))
        .join(F.broadcast(starts), ["shard", "cell"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("nth") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "group_key",
        )
    )
