"""Near-duplicate documents by b-bit MinHash with exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import hot_keys, materialise, released, spread_join
from lodestone.llm.graph import components
from lodestone.llm.shingles import intersection_size, mix, shingle_set

HASHES = 128
#: A pair at the threshold may share no band with this probability at most.
MISS = 1e-6
#: Low bits kept of each minimum; two unequal minima agree in them with probability 2 ** -BITS.
BITS = 4
#: Members of a group that are compared with its centre in one go.
BLOCK = 256

_RANDOM = np.random.RandomState(20240229)
_FACTOR = _RANDOM.randint(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFT = _RANDOM.randint(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_BAND_FACTOR = _RANDOM.randint(0, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of HASHES permutations over a set of hashes."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        values = low[at : at + 2048, None] * _FACTOR
        values += _SHIFT
        np.minimum(least, values.min(axis=0), out=least)
    return least


def banding(similarity: float) -> tuple[int, int]:
    """Bands, and minima in a band: as many minima as keep a pair's chance to share no band within MISS.

    At 0.85 these are 25 bands of 5 (4e-7), at 0.80 32 of 4 (5e-8), at 0.60 64 of 2 (4e-13);
    at low similarities one minimum a band is the least, whatever the chance.
    """
    return next(((HASHES // rows, rows) for rows in range(16, 1, -1) if (1 - similarity**rows) ** (HASHES // rows) <= MISS), (HASHES, 1))


def band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each row of minima; bands never share keys by design."""
    used = bands * rows
    sums = (least[:, :used].astype(np.uint64) * _BAND_FACTOR[:used]).reshape(len(least), bands, rows).sum(axis=2, dtype=np.uint64)
    return mix(sums + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def pack(least: np.ndarray) -> np.ndarray:
    """The low BITS bits of all minima as bit planes: BITS * 2 longs a row."""
    planes = []
    for bit in range(BITS):
        bits = ((least >> np.uint32(bit)) & np.uint32(1)).astype(np.uint8)
        planes.append(np.packbits(bits, axis=1).view(np.int64))
    return np.hstack(planes)


def largest_mismatch(similarity: float, sigmas: float = 6.0) -> int:
    """Minima that may differ in their low bits for a pair to stay a candidate.

    The share of agreeing minima P estimates the similarity J as
    (P - C) / (1 - C) with C = 2 ** -BITS, the chance collisions; the bound lies
    ``sigmas`` standard deviations below ``similarity``.
    """
    chance = 2.0**-BITS
    agree = similarity * (1 - chance) + chance
    return int(np.ceil(HASHES * (1 - agree) + sigmas * np.sqrt(HASHES * agree * (1 - agree))))


SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, signature array<long>"


def _sign(size: int, percent: int):
    bands, rows = banding(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = [shingle_set(t.as_buffer().to_pybytes() if t.is_valid else None, size) for t in part.column(1).cast(pa.binary())]
                n = np.array([len(s) for s in sets], np.int64)
                least = np.stack([minima(s) for s in sets])
                keys, signs = band_keys(least, bands, rows), pack(least)
                prints = np.array([[np.add.reduce(mix(s ^ np.uint64(k))) for k in (0x1234567, 0x89ABCDEF01)] for s in sets], np.uint64).view(np.int64)
                some = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        pa.array(n),
                        pa.array(prints[:, 0]),
                        pa.array(prints[:, 1]),
                        pa.ListArray.from_arrays(some, pa.array(keys[n > 0].ravel())),
                        pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * (2 * BITS), pa.array(signs.ravel())),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "signature"],
                )

    return run


def _confirm(size: int, percent: int):
    """Rows come sorted by (centre, block), the centre's own text first; yields the linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, centres = None, []
        for batch in batches:
            us, vs = [], []
            blocks, texts = batch.column("block").to_pylist(), batch.column("text").cast(pa.binary())
            for k, (centre, member) in enumerate(zip(batch.column("centre").to_pylist(), batch.column("member").to_pylist(), strict=True)):
                if group != (centre, blocks[k]):
                    group, centres = (centre, blocks[k]), []
                own = shingle_set(texts[k].as_buffer().to_pybytes() if texts[k].is_valid else None, size)
                if member is None:
                    centres.append(own)
                    continue
                for other in centres:
                    common = intersection_size(own, other)
                    if common and 100 * common >= percent * (len(own) + len(other) - common):
                        us.append(centre)
                        vs.append(member)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def _agree(a: str, b: str, most: int) -> Column:
    """Whether two packed signatures differ in ``most`` minima at most (bit counts over the planes)."""
    halves = []
    for half in (0, 1):
        differ = [F.col(f"{a}.s")[2 * bit + half].bitwiseXOR(F.col(f"{b}.s")[2 * bit + half]) for bit in range(BITS)]
        any_plane = differ[0]
        for d in differ[1:]:
            any_plane = any_plane.bitwiseOR(d)
        halves.append(F.bit_count(any_plane))
    return halves[0] + halves[1] <= most


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return small * 100 >= large * percent


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of the pairs ``(centre, member)`` those whose full shingle sets are similar enough, as ``(u, v)``.

    A centre's members are dealt out in blocks of about BLOCK, each with a copy
    of the centre's text, and stream past it: no task holds a group.
    """
    counted = pairs.groupBy("centre").agg(F.count("*").alias("n"))
    many = counted.select("centre", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("blocks"))
    members = spread_join(pairs, many, ["centre"], hot_keys(counted, "centre")).select("centre", "member", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int").alias("block"), F.col("member").alias("doc_id"))
    centres = many.select("centre", F.lit(None).cast("long").alias("member"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("centre").alias("doc_id"))
    rows = members.union(centres).join(docs, "doc_id").select("centre", "member", "block", "text")
    dealt = rows.repartition("centre", "block").sortWithinPartitions("centre", "block", F.col("member").asc_nulls_first())
    return dealt.mapInArrow(released(_confirm(size, percent)), "u long, v long")


def _cross(size: int, percent: int):
    """Rows come sorted by (cluster, i, j, side): the left block is held as an inverted index,
    the right one streams past it; yields a link for each two components that it finds linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sets, owners, index = None, [], [], None
        for batch in batches:
            us, vs = [], []
            columns = [batch.column(c).to_pylist() for c in ("cluster", "i", "j", "side", "node", "component", "main")]
            texts = batch.column("text").cast(pa.binary())
            for k, (cluster, i, j, side, node, component, main) in enumerate(zip(*columns, strict=True)):
                if group != (cluster, i, j):
                    group, sets, owners, index = (cluster, i, j), [], [], None
                own = shingle_set(texts[k].as_buffer().to_pybytes() if texts[k].is_valid else None, size)
                if side == 0:
                    sets.append(own)
                    owners.append((node, component))
                    continue
                if not sets or not len(own):
                    continue
                if index is None:
                    lengths = np.array([len(s) for s in sets])
                    keys, at = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
                    order = np.argsort(keys, kind="stable")
                    nodes, components_ = (np.array([o[x] for o in owners]) for x in (0, 1))
                    index = keys[order], at[order]
                low, high = np.searchsorted(index[0], own, "left"), np.searchsorted(index[0], own, "right")
                spread = high - low
                hits = np.repeat(low - np.cumsum(spread) + spread, spread) + np.arange(spread.sum())
                common = np.bincount(index[1][hits], minlength=len(sets))
                fits = (100 * common >= percent * (lengths + len(own) - common)) & (components_ != component)
                if component != main:
                    fits &= nodes < node
                found = np.flatnonzero(fits)
                for x in found[np.unique(components_[found], return_index=True)[1]]:
                    us.append(int(nodes[x]))
                    vs.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def _within_clusters(clusters: DataFrame, linked: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between components of one cluster, as ``(u, v)``.

    In a cluster of several components, the documents outside its largest one
    are compared with all its documents, block by block on full sets; pairs are
    counted inside a task and never become rows.
    """
    nodes = clusters.join(linked, "node", "left").select("cluster", "node", F.coalesce("component", "node").alias("component"))
    parts = nodes.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("cluster").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("in_main"), F.count("*").alias("parts")
    )
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    mixed = mixed.where("parts > 1").select("cluster", "main", blocks(F.col("n") - F.col("in_main")).alias("left_blocks"), blocks(F.col("n")).alias("right_blocks"))
    rows = spread_join(nodes, mixed, ["cluster"], hot_keys(clusters.groupBy("cluster").agg(F.count("*").alias("n")), "cluster"))
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where("component <> main").withColumn("i", place("left_blocks")).withColumn("j", every("right_blocks")).withColumn("side", F.lit(0))
    right = rows.withColumn("j", place("right_blocks")).withColumn("i", every("left_blocks")).withColumn("side", F.lit(1))
    both = left.select("cluster", "i", "j", "side", "node", "component", "main").union(right.select("cluster", "i", "j", "side", "node", "component", "main"))
    dealt = both.join(texts.withColumnRenamed("doc_id", "node"), "node").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "side")
    return dealt.mapInArrow(released(_cross(size, percent)), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents linked by a shingle-set similarity of ``percent`` / 100 or more.

    Returns one row per input row: ``doc_id, n_shingles, component_id, kept``;
    ``component_id`` is the smallest id reachable over links, ``kept`` marks it.

    Method: b-bit MinHash. One pass hashes each text's distinct shingles, takes
    HASHES minima, keeps their low BITS bits as packed bit planes and forms band
    keys, so many that a pair at the threshold shares none with probability MISS at
    most (:func:`banding`). Documents of equal sets become one class before anything else. In
    each band bucket every class is paired with the bucket's smallest class only;
    pairs whose collision-corrected similarity estimate (bit counts over the
    planes) lies six standard deviations below the threshold go, the others are
    confirmed on full sets. Pairs that passed the estimate also make clusters: in
    buckets that hold several clusters, classes outside the bucket's largest one
    are estimated against all of the others, and confirmed likewise. Last, in
    clusters that the links leave in several components, the documents outside
    the largest component are compared with the whole cluster on full sets, block
    by block. So no bucket or group is capped, pairs within a component, which can
    change nothing, are never formed, and pairs of a large group never become rows.
    Joins deal the rows of hot buckets, centres, clusters and classes to many tasks.

    Texts are lower-cased (A-Z); words are runs other than space and controls 9
    to 13; a text of fewer words than a shingle counts as one shingle. Null and
    blank texts have the empty set and are linked with nothing. Rows that share
    an id are one document, linked by either text. A null id is its own group:
    ``component_id`` null, ``kept`` true. Texts of any length are hashed whole, in
    pieces. An empty table gives no rows. Other columns are not read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = materialise(own.mapInArrow(released(_sign(shingle_words, percent)), SIGNED), "signed")
    most = largest_mismatch(percent / 100)

    some = signed.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("set_a", "set_b", F.col("n_shingles").alias("n")).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("signature").alias("s"))
    classes = materialise(classes, "classes")
    keyed = classes.select("rep", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("last"), F.count("*").alias("n")).where("centre <> last")
    buckets = materialise(buckets.select("key", "centre", "n"), "buckets")
    hot = hot_keys(buckets, "key")
    shared = materialise(spread_join(keyed, buckets.select("key", "centre"), ["key"], hot), "shared")
    signs = classes.select("rep", "n", "s")

    def estimated(pairs: DataFrame) -> DataFrame:
        a = signs.select(F.col("rep").alias("centre"), F.struct("n", "s").alias("a"))
        b = signs.select(F.col("rep").alias("member"), F.struct("n", "s").alias("b"))
        pairs = materialise(pairs, "starred")
        both = spread_join(pairs.join(b, "member"), a, ["centre"], hot_keys(pairs.groupBy("centre").agg(F.count("*").alias("n")), "centre"))
        return both.where(_sizes_fit("a", "b", percent) & _agree("a", "b", most)).select("centre", "member").distinct()

    stars = materialise(estimated(shared.where("rep <> centre").select("centre", F.col("rep").alias("member")).distinct()), "stars")
    clusters = materialise(components(stars.select(F.col("centre").alias("u"), F.col("member").alias("v"))).select("node", F.col("component").alias("cluster")), "clusters")

    # Pairs that share a bucket but no cluster.
    placed = shared.join(clusters, shared["rep"] == clusters["node"], "left").select("key", "rep", F.coalesce("cluster", "rep").alias("cluster"))
    parts = placed.groupBy("key", "cluster").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("key").agg(F.max_by("cluster", F.struct("n", "cluster")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("key", "main")
    open_rows = spread_join(placed, mixed, ["key"], hot).join(signs, "rep")
    others = open_rows.where("cluster <> main").select("key", F.struct("rep", "cluster", "main", "n", "s").alias("a"))
    everyone = open_rows.select("key", F.struct("rep", "cluster", "main", "n", "s").alias("b"))
    # Of two outsiders the one with the smaller id is the left one; a member of the main cluster is always the right one.
    once = (F.col("b.cluster") == F.col("b.main")) | (F.col("a.rep") < F.col("b.rep"))
    apart = (
        spread_join(everyone, others, ["key"], hot)
        .where((F.col("a.cluster") != F.col("b.cluster")) & once & _sizes_fit("a", "b", percent) & _agree("a", "b", most))
        .select(F.least("a.rep", "b.rep").alias("centre"), F.greatest("a.rep", "b.rep").alias("member"))
        .distinct()
    )
    pairs = materialise(stars.union(apart), "pairs")
    involved = pairs.select(F.col("centre").alias("doc_id")).union(pairs.select(F.col("member").alias("doc_id"))).distinct()
    # A merge join at every size: what is broadcast here would grow with the links.
    texts = materialise(own.join(involved.hint("merge"), "doc_id"), "texts")

    links = materialise(_confirmed(pairs, texts, shingle_words, percent), "links")
    first = materialise(components(links), "components")
    more = _within_clusters(clusters, first, texts, shingle_words, percent)
    last = components(more.union(first.select(F.col("node").alias("u"), F.col("component").alias("v"))))

    group = classes.join(last, F.col("rep") == F.col("node"), "left").select("set_a", "set_b", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    sets = ["set_a", "set_b", "n_shingles"]
    copied = hot_keys(classes.withColumnRenamed("n", "n_shingles"), *sets, n="copies")
    grouped = spread_join(some.select("doc_id", *sets), group, sets, copied).select("doc_id", "n_shingles", "component_id")
    alone = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
