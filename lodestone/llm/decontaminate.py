"""Benchmark decontamination with one Aho-Corasick automaton."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import accumulate, chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import materialise, released

#: An automaton has at most so many nodes of about 40 bytes; a benchmark that needs
#: more is scanned by several automata, one after the other, with the same result.
MAX_NODES = 6 << 20
#: Rows of a batch that are made into results at a time.
ROWS = 256

# Bytes of words (0-9, a-z after lower-casing A-Z, all of non-ASCII) as they are, others a space.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_INSIDE = np.array([b != 32 for b in _NORMAL])


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split()


def windows_of(words: list[bytes], size: int) -> list[bytes]:
    """All windows of ``size`` words, space-delimited on both sides; a shorter item is one window."""
    if not words:
        return []
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))]


def build(items: list[tuple[str | None, bytes]], size: int) -> ahocorasick.Automaton:
    """Automaton over the windows of ``(item id, normalised text)``; a hit gives (word count, item ids)."""
    owners: dict[bytes, set[str | None]] = {}
    for item, text in items:
        for w in windows_of(text.split(), size):
            owners.setdefault(w, set()).add(item)
    found = ahocorasick.Automaton()
    for w, ids in owners.items():
        found.add_word(w.decode("utf-8", "surrogateescape"), (w.count(b" ") - 1, tuple(ids)))
    if len(found):
        found.make_automaton()
    return found


def scan(text: str | None, automaton: ahocorasick.Automaton) -> tuple[int, np.ndarray, set[str]]:
    """Words of a text, the ``[start, end)`` word ranges of all occurrences, merged, and the items hit."""
    words = normal_words(text)
    if not words or not len(automaton):
        return len(words), np.empty((0, 2), np.int64), set()
    line = (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogateescape")
    ends: list[int] = []
    sizes: list[int] = []
    items: set[str] = set()
    for at, (n, ids) in automaton.iter(line):
        ends.append(at)
        sizes.append(n)
        items.update(ids)
    if not ends:
        return len(words), np.empty((0, 2), np.int64), items
    # The space at `at` follows word number k: k spaces stand before it, the leading one included.
    spaces = np.fromiter(accumulate(len(w) + 1 for w in line[1:-1].split(" ")), np.int64, len(words))
    last = np.searchsorted(spaces, ends) + 1
    return len(words), merge(np.column_stack([last - np.array(sizes), last])), items


def merge(ranges: np.ndarray) -> np.ndarray:
    """Sorted, disjoint ranges that cover what ``ranges`` cover."""
    if not len(ranges):
        return ranges.reshape(0, 2)
    ranges = ranges[np.lexsort((ranges[:, 1], ranges[:, 0]))]
    reach = np.maximum.accumulate(ranges[:, 1])
    fresh = np.concatenate([[True], ranges[1:, 0] > reach[:-1]])
    return np.column_stack([ranges[fresh, 0], reach[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(ranges) - 1]])]])


def char_spans(text: str, ranges: np.ndarray) -> list[tuple[int, int]]:
    """Word ranges as character spans of the original text."""
    if not len(ranges):
        return []
    data = text.encode()
    edge = np.flatnonzero(np.diff(_INSIDE[np.frombuffer(data, np.uint8)], prepend=False, append=False))
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
    return [(int(chars[edge[2 * a]]), int(chars[edge[2 * b - 1]])) for a, b in ranges]


def cut(text: str | None, ranges: np.ndarray) -> str | None:
    """The text without the passages of the given word ranges."""
    if text is None or not len(ranges):
        return text
    spans = char_spans(text, ranges)
    return "".join(text[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)], strict=True))


SCHEMA = "n_words long, ranges array<struct<start:long,end:long>>, items array<string>, clean_text string"


#: The automaton that a worker built last, kept from task to task.
_built: dict[str, ahocorasick.Automaton] = {}


def _scan_all(held, size: int, with_text: bool, only_hits: bool = False):
    """Scans each text for the windows of a broadcast slice of items; a worker builds the automaton once."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _built:
            _built.clear()
            _built[name] = build(held.value, size)
        own = _built[name]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            n_words, all_ranges, all_items, clean = [], [], [], []
            for cell in batch.column("text"):
                text = cell.as_py()
                n, ranges, items = scan(text, own)
                n_words.append(n)
                all_ranges.append([{"start": int(a), "end": int(b)} for a, b in ranges])
                all_items.append(in_order(items))
                clean.append(cut(text, ranges) if with_text else None)
            made = [pa.array(n_words, pa.int64()), pa.array(all_ranges, kind), pa.array(all_items, pa.list_(pa.string())), pa.array(clean, pa.string())]
            kept = [n for n in batch.schema.names if n != "text"]
            done = pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *made], names=[*kept, "n_words", "ranges", "items", "clean_text"])
            yield done.filter(pa.array([len(r) > 0 for r in all_ranges], pa.bool_())) if only_hits else done

    return released(run)


def in_order(items: set[str | None]) -> list[str | None]:
    """Ids sorted as strings, a null id last."""
    return sorted((i for i in items if i is not None)) + ([None] if None in items else [])


def _slices(benchmark: DataFrame, size: int, most: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark's items in slices whose automata have ``most`` nodes at most; streamed, never held whole.

    A window of n characters adds n nodes at most. An item that alone needs more is
    parted; its pieces overlap by a window less one word, so that no window is lost.
    """
    held, used = [], 0
    for row in benchmark.toLocalIterator():
        words = normal_words(row["text"])
        if not words:
            continue
        lengths = np.array([len(w) + 1 for w in words])
        nodes = np.convolve(lengths, np.ones(min(size, len(words)), np.int64), "valid") + 1
        start, cost = 0, np.cumsum(nodes)
        while start < len(nodes):
            base = cost[start - 1] if start else 0
            stop = max(int(np.searchsorted(cost, base + most - used, "right")), start + (not held))
            if stop > start:
                held.append((row["item_id"], b" ".join(words[start : stop + size - 1])))
                used += int(cost[stop - 1] - base)
                start = stop
            if start < len(nodes):
                yield held
                held, used = [], 0
    if held:
        yield held


def find_contamination(docs: DataFrame, benchmark: DataFrame, columns: list[str], text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 10, with_text: bool = False, max_nodes: int = MAX_NODES) -> DataFrame:
    """Occurrences of benchmark windows in whole texts.

    Returns, for each row of ``docs``, its ``columns`` and ``n_words``, ``ranges``
    (merged word ranges of all occurrences), ``items`` (ids of items with an
    occurring window, sorted as strings) and ``clean_text`` (the text without
    the hit passages, if ``with_text``). The benchmark is normalised once and its
    texts are broadcast; each worker builds the automaton of their windows, each
    document is scanned once, and word ranges map back to characters of the original.

    What is broadcast and the automaton are bounded by ``max_nodes``, the automaton's
    largest number of nodes. A benchmark that needs more is scanned in slices: each
    slice writes its hit rows only, which are united and joined to the others; no
    slice is dropped.

    Words are runs of 0-9, a-z and non-ASCII characters after lower-casing A-Z.
    A window is ``window`` consecutive words of an item; an item of fewer words is
    one window; an item without words, or null, has none. Items with a null id are
    looked for like all others, and stand in ``items`` as one null, the last. Null
    texts have no words and no hits. Texts of any length are scanned whole, one at a
    time. Repeated rows and repeated items are harmless; empty tables give no rows,
    or rows without hits. ``columns`` that bear names of the result are replaced by
    it, and other columns are not read.
    """
    spark = docs.sparkSession
    columns = [c for c in columns if c not in ("n_words", "ranges", "items", "clean_text")]
    base = docs.select(*[F.col(f"`{c}`") for c in columns if c != "text"], F.col(f"`{text_col}`").cast("string").alias("text"))
    kept = [f for f in base.schema.fields if f.name != "text"]
    lead = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text is not null")
    slices = _slices(items, window, max_nodes)
    first, second = next(slices, []), next(slices, None)
    if second is None:
        return base.mapInArrow(_scan_all(spark.sparkContext.broadcast(first), window, with_text), lead + SCHEMA)
    # Several slices: the same scan for each; only rows with a hit are written and shuffled.
    keyed = materialise(base.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    union = None
    for part in chain([first, second], slices):
        one = keyed.select("_row", "text").mapInArrow(_scan_all(spark.sparkContext.broadcast(part), window, False, only_hits=True), "_row long, " + SCHEMA)
        one = materialise(one.drop("clean_text", "n_words"), "slice")
        union = one if union is None else union.union(one)
    whole = union.groupBy("_row").agg(F.flatten(F.collect_list("ranges")).alias("ranges"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return keyed.join(whole, "_row", "left").drop("_row").mapInArrow(_unite(with_text), lead + SCHEMA)


def _unite(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            n_words, ranges, items, clean = [], [], [], []
            for text, found, ids in zip(*(batch.column(c).to_pylist() for c in ("text", "ranges", "items")), strict=True):
                whole = merge(np.array([(r["start"], r["end"]) for r in found or []], np.int64).reshape(-1, 2))
                n_words.append(len(normal_words(text)))
                ranges.append([{"start": int(a), "end": int(b)} for a, b in whole])
                items.append(ids or [])
                clean.append(cut(text, whole) if with_text else None)
            kept = [n for n in batch.schema.names if n not in ("text", "ranges", "items")]
            made = [pa.array(n_words, pa.int64()), pa.array(ranges, batch.column("ranges").type), pa.array(items, pa.list_(pa.string())), pa.array(clean, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *made], names=[*kept, "n_words", "ranges", "items", "clean_text"])

    return released(run)
