"""Removal of passages that a document shares with an earlier one."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import hot_keys, materialise, released, spread_join
from lodestone.llm.quality import count_spaces, has_word, let
from lodestone.llm.shingles import mix

#: Later documents that are aligned with an earlier one in one go.
BLOCK = 256


def heaviest_chain(points: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Of ``(i, j, weight)`` with rising, distinct i the chain with rising j that weighs most."""
    ends: list[int] = []  # j of the best chain ends, rising
    best: list[int] = []  # their weights, rising too
    last: list[int] = []  # their points
    back: list[int] = []
    for k, (_, j, weight) in enumerate(points):
        at = bisect_left(ends, j)
        total = weight + (best[at - 1] if at else 0)
        back.append(last[at - 1] if at else -1)
        stop = bisect_right(best, total, at)
        ends[at:stop], best[at:stop], last[at:stop] = [j], [total], [k]
    chain, k = [], last[-1] if last else -1
    while k >= 0:
        chain.append(points[k][:2])
        k = back[k]
    return chain[::-1]


def numbered(hashes: list[int]) -> list[tuple[int, int]]:
    """Each line with the count of its equals before it: a key that is unique in its document."""
    seen: dict[int, int] = {}
    keys = []
    for h in hashes:
        seen[h] = n = seen.get(h, 0) + 1
        keys.append((h, n))
    return keys


def minimal_runs(words: np.ndarray, least: int, begin=0, end=None) -> tuple[np.ndarray, np.ndarray]:
    """All shortest runs of lines that reach ``least`` words, from each line forwards and from each backwards, as (starts, stops).

    Every run of at least ``least`` words is covered by the minimal runs inside it.
    ``begin`` and ``end`` are the bounds of each line's document, if there are several.
    """
    after = np.cumsum(words)
    before = after - words
    end = len(words) if end is None else end
    places = np.arange(len(words))
    stops = np.searchsorted(after, before + least) + 1
    starts = np.searchsorted(before, after - least, "right") - 1
    forward, backward = stops <= end, starts >= begin
    return np.concatenate([places[forward], starts[backward]]), np.concatenate([stops[forward], places[backward] + 1])


def aligned_blocks(later: list[int], earlier: list[int], words: list[int], least: int) -> list[int]:
    """Places in ``later`` of lines in common blocks of at least ``least`` words.

    Patience alignment: lines unique in both documents (the n-th equal line
    counts as a line of its own) are chained in rising order, the heaviest chain
    by words; runs of it that are contiguous in both are the blocks. Lines that
    stand in both and are in no block yet, in another order or beside a repeated
    line, are then tried in all their occurrences: a minimal run of ``later`` that
    stands anywhere in ``earlier`` is a block too. Both passes take time in
    proportion to the lines (times a logarithm), in whatever order they stand.
    """
    where = {key: j for j, key in enumerate(numbered(earlier))}
    chain = heaviest_chain([(i, where[key], words[i]) for i, key in enumerate(numbered(later)) if key in where])
    gone: set[int] = set()
    start = 0
    for k in range(1, len(chain) + 1):
        if k == len(chain) or chain[k] != (chain[k - 1][0] + 1, chain[k - 1][1] + 1):
            block = [i for i, _ in chain[start:k]]
            if sum(words[i] for i in block) >= least:
                gone.update(block)
            start = k
    return sorted(gone | _blocks_elsewhere(later, earlier, words, least, gone))


def _blocks_elsewhere(later: list[int], earlier: list[int], words: list[int], least: int, gone: set[int]) -> set[int]:
    """Places of the minimal runs of ``later``, not wholly in ``gone``, that stand at any place of ``earlier``."""
    common = set(earlier)
    left = np.array([i not in gone and h in common for i, h in enumerate(later)])
    if not left.any():
        return set()
    spans = zip(*(x.tolist() for x in minimal_runs(np.array(words), least)), strict=True)
    open_before = np.concatenate([[0], np.cumsum(left)]).tolist()
    tried = [(a, b) for a, b in spans if open_before[b] > open_before[a] and common.issuperset(later[a:b])]
    if not tried:
        return set()
    # A line that only the earlier document holds ends every run.
    weight = dict(zip(later, words, strict=True))
    theirs = minimal_runs(np.array([weight.get(h, least) for h in earlier]), least)
    held = {tuple(earlier[a:b]) for a, b in zip(*(x.tolist() for x in theirs), strict=True)}
    return {i for a, b in tried if tuple(later[a:b]) in held for i in range(a, b)}


#: Odd, so that its powers have inverses modulo 2 ** 64.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def run_hashes(h: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of the lines of each run, from differences of one polynomial prefix sum."""
    powers, inverses = (np.full(len(h) + 1, f, np.uint64) for f in (_FACTOR, _INVERSE))
    powers[0] = inverses[0] = 1
    powers, inverses = np.cumprod(powers), np.cumprod(inverses)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h.view(np.uint64)) * powers[:-1])])
    return mix((sums[stops] - sums[starts]) * inverses[starts] + (stops - starts).astype(np.uint64)).view(np.int64)


def _hash_runs(least: int):
    """Yields the hashes of each document's minimal runs, once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sizes = np.array([len(x) for x in part.column("h")], np.int64)
                h, w = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("h", "w"))
                last = np.cumsum(sizes)
                row = np.repeat(np.arange(len(sizes)), sizes)
                starts, stops = minimal_runs(w.astype(np.int64), least, (last - sizes)[row], last[row])
                row, runs = row[starts], run_hashes(h.astype(np.int64), starts, stops)
                order = np.lexsort((runs, row))
                row, runs = row[order], runs[order]
                fresh = np.ones(len(row), bool)
                fresh[1:] = (row[1:] != row[:-1]) | (runs[1:] != runs[:-1])
                holder = pa.array(row[fresh])
                yield pa.RecordBatch.from_arrays([part.column("id").take(holder), part.column("text_hash").take(holder), pa.array(runs[fresh])], names=["id", "text_hash", "run"])

    return run


def _align(least: int):
    """Rows come sorted by (earlier document, block), its own lines first; yields places to delete."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("e_id", "e_text", "block", "l_id", "l_text", "h", "w")]
            ids, texts, gone = [], [], []
            for e_id, e_text, block, l_id, l_text, h, w in zip(*columns, strict=True):
                if group != (e_id, e_text, block):
                    group, own = (e_id, e_text, block), None
                if l_id is None:
                    own = h
                elif own is not None and (places := aligned_blocks(h, own, w, least)):
                    ids.append(l_id)
                    texts.append(l_text)
                    gone.append(places)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], names=["id", "text_hash", "gone"])

    return run


def remove_shared_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_block_words: int = 20) -> DataFrame:
    """Delete from each document the passages that an earlier document holds.

    Lines are what ``\\n`` parts; those with a word count. Every minimal run of
    consecutive lines that reaches ``min_block_words`` words (spaces + 1 a line)
    pairs each of its holders with its earliest one, whatever their number; every
    block that any earlier document holds is covered by such runs. The pair's lines
    are aligned (:func:`aligned_blocks`), and common blocks of at least so many
    words are deleted from the later document, the one with the larger id. A block's
    lines all stand in an earlier document, and the earliest holder of a line never
    loses it, so one copy stays.

    Returns the columns of ``docs``, with the text cleaned, and ``n_lines``,
    ``n_deleted`` (lines) and ``kept`` (false if every line with a word was
    deleted); these replace columns of such names. Texts without deletions stay
    as they are, byte for byte. Null and blank texts and rows with a null id are
    left alone (``kept`` true). Rows with equal id and text are one document, and
    get equal answers; rows with equal id and other text are ordered by a hash of
    the text. An empty table gives no rows. Texts of any length are handled whole, as
    one row of line hashes.

    The earlier document's lines (hashes, not texts) are copied to blocks of about
    BLOCK later ones and each of these streams past them: no task holds all
    documents that share a line; the rows of a hot run or document are dealt to many tasks.
    """
    text = F.col(f"`{text_col}`").cast("string")
    key = [F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("text_hash")]
    parts = F.filter(F.split(text, "\n"), has_word)
    sequences = docs.where(F.col(f"`{id_col}`").isNotNull() & text.isNotNull()).select(
        *key, let(parts, lambda p: F.struct(F.transform(p, lambda x: F.xxhash64(x)).alias("h"), F.transform(p, lambda x: count_spaces(x) + 1).alias("w"))).alias("s")
    )
    sequences = materialise(sequences.select("id", "text_hash", "s.h", "s.w").where("size(h) > 0").dropDuplicates(["id", "text_hash"]), "sequences")

    runs = sequences.mapInArrow(released(_hash_runs(min_block_words)), "id long, text_hash long, run long").select(F.struct("id", "text_hash").alias("r"), "run")
    runs = materialise(runs, "runs")
    holders = runs.groupBy("run").agg(F.min("r").alias("e"), F.max("r").alias("last"), F.count("*").alias("n")).where("e <> last")
    holders = materialise(holders.select("run", "e", "n"), "holders")
    shared = spread_join(runs, holders.select("run", "e"), ["run"], hot_keys(holders, "run"))
    pairs = materialise(shared.where("r <> e").select(F.col("r").alias("l"), "e").distinct(), "pairs")

    counted = pairs.groupBy("e").agg(F.count("*").alias("n"))
    many = counted.select("e", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("blocks"))
    later = spread_join(pairs, many, ["e"], hot_keys(counted, "e")).select("e", F.pmod(F.xxhash64("l"), F.col("blocks")).cast("int").alias("block"), "l", F.col("l").alias("r"))
    nobody = F.lit(None).cast("struct<id:bigint,text_hash:bigint>")
    earlier = many.select("e", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), nobody.alias("l"), F.col("e").alias("r"))
    rows = later.union(earlier).join(sequences.select(F.struct("id", "text_hash").alias("r"), "h", "w"), "r")
    rows = rows.select(F.col("e.id").alias("e_id"), F.col("e.text_hash").alias("e_text"), "block", F.col("l.id").alias("l_id"), F.col("l.text_hash").alias("l_text"), "h", "w")
    dealt = rows.repartition("e_id", "e_text", "block").sortWithinPartitions("e_id", "e_text", "block", F.col("l_id").asc_nulls_first())
    deleted = dealt.mapInArrow(released(_align(min_block_words)), "id long, text_hash long, gone array<int>")
    deleted = deleted.select("id", "text_hash", F.explode("gone").alias("g")).groupBy("id", "text_hash").agg(F.collect_set("g").alias("gone"))

    own = [c for c in docs.columns if c not in ("n_lines", "n_deleted", "kept")]
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), *key).join(deleted, ["id", "text_hash"], "left")
    body = F.split(F.col(f"row.`{text_col}`").cast("string"), "\n")

    def rest(all_lines):
        # Places count lines with a word; a blank line goes only with its whole text.
        with_word = F.filter(F.transform(all_lines, lambda x, i: F.when(has_word(x), i)), lambda i: i.isNotNull())
        gone = let(with_word, lambda k: F.transform(F.col("gone"), lambda g: F.get(k, g)))
        keep = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), gone)
        return F.array_join(F.transform(keep, lambda i: F.get(all_lines, i)), "\n")

    clean = F.when(F.col("gone").isNull(), F.col(f"row.`{text_col}`")).otherwise(let(body, rest))
    n_lines = F.coalesce(F.size(F.filter(body, has_word)), F.lit(0)).cast("long")
    n_deleted = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    columns = [clean.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in own]
    return base.select(*columns, n_lines.alias("n_lines"), n_deleted.alias("n_deleted"), ((n_deleted == 0) | (n_deleted < n_lines)).alias("kept"))
