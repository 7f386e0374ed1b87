"""The corpus operators on small tables: edge cases and brute force."""

import collections
import gzip
import hashlib
import heapq
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestone.llm import bpe, common, decontaminate, graph, linededup, minhash, quality, sharding, shingles, tokencount, toxicity, urlfilter, warc

DOCS = "doc_id long, text string, shard string, n_words string, kept string"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def docs(spark, texts, first=1):
    """Texts with ids, and columns whose names clash with the operators'."""
    return spark.createDataFrame([(k, t, "x", "y", "z") for k, t in enumerate(texts, first)], DOCS)


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


# --- 1 -------------------------------------------------------------------------------------
def plain_lpt(sizes, n_shards):
    """One heap, item by item: how many items of each size every shard gets."""
    heap, got = [(0, j) for j in range(n_shards)], {}
    for size in sorted(sizes, reverse=True):
        load, j = heapq.heappop(heap)
        got[size, j] = got.get((size, j), 0) + 1
        heapq.heappush(heap, (load + size, j))
    return got


def test_runs_of_equal_sizes_are_dealt_as_one_by_one():
    rng = random.Random(1)
    for _ in range(300):
        n, sizes = rng.randint(1, 7), [rng.choice([1, 2, 3, 8, 9, 30]) for _ in range(rng.randint(0, 60))]
        counted = sorted(collections.Counter(sizes).items(), reverse=True)
        got = {(size, j): end - start for size, ends in sharding.schedule(counted, n) for j, (start, end) in enumerate(itertools.pairwise([0, *ends])) if end > start}
        assert got == plain_lpt(sizes, n)


@pytest.mark.parametrize("ranked", [sharding.RANKED, 4])
def test_shards_are_those_of_plain_lpt(spark, monkeypatch, ranked):
    monkeypatch.setattr(sharding, "RANKED", ranked)
    monkeypatch.setattr(sharding, "LARGE", 10)
    texts = [prose(i % 40 + 1, i) for i in range(300)] + ["same text"] * 60 + [f"t{k:03}" for k in range(80)] + [None, None, "", "é" * 5000]
    table = docs(spark, texts).union(docs(spark, ["twice", "twice"], 9999)).union(spark.createDataFrame([(None, "no id", "x", "y", "z")] * 5 + [(1, texts[0], "x", "y", "z")], DOCS))
    rows = sharding.shard(table, 6).collect()
    held = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert sorted((r["doc_id"] or 0, r["size"], -1 if r["text_crc32"] is None else r["text_crc32"]) for r in rows) == sorted((k or 0, len((t or "").encode()) + 8, -1 if t is None else zlib.crc32(t.encode())) for k, t in held)
    groups = {}
    for r in rows:
        groups.setdefault(bytes(r["group_key"]), []).append(r)
    assert len(groups) == len({t for _, t in held}) and all(len({r["shard"] for r in g}) == 1 for g in groups.values())
    got = collections.Counter((sum(r["size"] for r in g), g[0]["shard"]) for g in groups.values())
    by_text = collections.Counter()
    for _, t in held:
        by_text[t] += len((t or "").encode()) + 8
    assert got == plain_lpt(by_text.values(), 6)
    for s in range(6):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard(docs(spark, []), 6).count() == 0


# --- 2 -------------------------------------------------------------------------------------
def words_set(text, n):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_components(texts, n, percent):
    sets = [words_set(t, n) for t in texts]
    group = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        i = len(sets[a] & sets[b])
        if i and 100 * i >= percent * len(sets[a] | sets[b]):
            x, y = sorted((group[a], group[b]))
            group = [x if g == y else g for g in group]
    return [(k + 1, len(s), g + 1) for k, (s, g) in enumerate(zip(sets, group, strict=True))]


def near_texts():
    rng, out = random.Random(5), []
    for base in range(6):
        words = prose(60, base).split()
        for _ in range(7):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(999)}"
            out.append(" ".join(copy))
    return [*out, "one", "One", "two words", "", None, "  \n", "a\x00b c d", out[0], out[0].upper()]


@pytest.mark.parametrize(("size", "percent", "least"), [(3, 85, 1024), (3, 85, 2)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, size, percent, least):
    monkeypatch.setattr(common, "LEAST", least)
    texts = near_texts()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs(spark, texts), shingle_words=size, percent=percent).collect())
    assert got == brute_components(texts, size, percent)


def test_signature_estimates_similarity():
    a = shingles.shingle_set(prose(2000, 1), 1)
    both = np.union1d(a, shingles.shingle_set(prose(200, 2), 1))
    x, y = minhash.minima(a), minhash.minima(both)
    px, py = (minhash.pack(m[None])[0].view(np.uint64) for m in (x, y))
    differ = [int(px[2 * b + h] ^ py[2 * b + h]) for b in range(minhash.BITS) for h in (0, 1)]
    count = sum(bin(differ[h] | differ[2 + h] | differ[4 + h] | differ[6 + h]).count("1") for h in (0, 1))
    assert count == int(np.count_nonzero((x ^ y) & 15))
    estimate = (1 - count / minhash.HASHES - 1 / 16) / (15 / 16)
    assert abs(estimate - len(np.intersect1d(a, both)) / len(both)) < 0.15


def test_long_texts_hash_in_pieces(monkeypatch):
    text = prose(3000, 3)
    whole = shingles.shingle_set(text, 3)
    monkeypatch.setattr(shingles, "PIECE", 100)
    assert np.array_equal(whole, shingles.shingle_set(text, 3))


@pytest.mark.parametrize("hot_n", [0, 1, 3000])
def test_spread_join_is_a_join_in_parts(spark, hot_n):
    rows = spark.createDataFrame([(7 if k < hot_n else k, k) for k in range(4000)], "k long, v long").union(spark.createDataFrame([(None, -1)], "k long, v long"))
    known = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    hot = common.hot_keys(rows.groupBy("k").agg(F.count("*").alias("n")), "k")
    assert list(hot.values()) == ([4] if hot_n == 3000 else [])
    got = sorted(tuple(r) for r in common.spread_join(rows, known, ["k"], hot).select("k", "v", "w").collect())
    assert got == sorted((7 if k < hot_n else k, k, 2 * (7 if k < hot_n else k)) for k in range(4000))
    empty = common.hot_keys(rows.where("false").groupBy("k").agg(F.count("*").alias("n")), "k")
    assert empty == {} and common.spread_join(rows.where("false"), known, ["k"], empty).isEmpty()


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(50, 51), (51, 52), (60, 60), (50, 51)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(1, 31), 1), 50: 50, 51: 50, 52: 50}


# --- 3 -------------------------------------------------------------------------------------
def test_heaviest_chain_is_optimal():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(0, 7)
        points = [(i, j, rng.randint(1, 9)) for i, j in enumerate(rng.sample(range(20), n))]
        best = max((sum(p[2] for p in c) for k in range(n + 1) for c in itertools.combinations(points, k) if all(a[1] < b[1] for a, b in itertools.pairwise(c))), default=0)
        weight = {p[:2]: p[2] for p in points}
        assert sum(weight[p] for p in linededup.heaviest_chain(points)) == best


def test_lines(spark):
    passage, other = prose(60, 1), prose(30, 2)
    short = "see you soon"
    texts = [f"a b c\n{passage}\nd e", f"x y\n\n{passage}\n{short}", f"{other}\n{passage}", f"{passage}\n{other}", short, f"{short}\nown words", passage, "", None, " \n ", passage]
    got = {r["doc_id"]: r for r in linededup.remove_shared_passages(docs(spark, texts)).collect()}
    assert got[1]["text"] == texts[0] and got[2]["text"] == f"x y\n\n{short}" and got[3]["text"] == other
    assert got[4]["text"] == "" and got[4]["kept"] is False and got[7]["kept"] is False and got[11]["kept"] is False
    assert [got[k]["text"] for k in (5, 6, 8, 9, 10)] == [texts[k - 1] for k in (5, 6, 8, 9, 10)]
    assert got[1]["shard"] == "x" and got[2]["n_deleted"] == 1


def test_lines_that_many_documents_hold(spark):
    # Lines held by more than eight documents, whose earliest holders are other documents than the passage's.
    one, two = prose(12, 1), prose(12, 2)
    texts = [one, two] + [f"{one}\n{two}\nown {k}" for k in range(9)]
    got = {r["doc_id"]: r["text"] for r in linededup.remove_shared_passages(docs(spark, texts)).collect()}
    assert [got[k] for k in (1, 2, 3)] == texts[:3] and [got[k] for k in range(4, 12)] == [f"own {k}" for k in range(1, 9)]
    # All pairs of all documents, with no rule for pairing.
    rng = random.Random(3)
    lines = [prose(rng.randint(3, 12), k) for k in range(8)]
    held = [[rng.randrange(8) for _ in range(rng.randint(1, 9))] for _ in range(50)]
    size = [x.count(" ") + 1 for x in lines]
    left = {r["doc_id"]: r["text"] for r in linededup.remove_shared_passages(docs(spark, ["\n".join(lines[i] for i in h) for h in held])).collect()}
    for k, own in enumerate(held):
        gone = {i for e in held[:k] for i in linededup.aligned_blocks(own, e, [size[x] for x in own], 20)}
        assert left[k + 1] == "\n".join(lines[x] for i, x in enumerate(own) if i not in gone)


def test_lines_in_all_their_occurrences():
    # Line 1 stands before the passage in the earlier document, and the later one holds the passage twice.
    assert linededup.aligned_blocks([1, 2], [1, 9, 1, 2], [11, 10], 20) == [0, 1]
    assert linededup.aligned_blocks([1, 2, 7, 1, 2], [1, 2], [11, 10, 5, 11, 10], 20) == [0, 1, 3, 4]
    rng = random.Random(8)
    for _ in range(400):
        later, earlier = ([rng.randrange(5) for _ in range(rng.randint(1, 12))] for _ in range(2))
        words = [3 + h for h in later]
        blocks = [range(a, b) for a in range(len(later)) for b in range(a + 1, len(later) + 1) if sum(words[a:b]) >= 12]
        inside = [r for r in blocks if any(earlier[k : k + len(r)] == later[r.start : r.stop] for k in range(len(earlier)))]
        assert linededup.aligned_blocks(later, earlier, words, 12) == sorted({i for r in inside for i in r})


# --- 4 -------------------------------------------------------------------------------------
def test_chunked_bpe_is_the_librarys(monkeypatch):
    library = Tokenizer.from_file(BYTE)
    rng = random.Random(2)
    parts = ["a", " ", "  ", "\n", "'", "re", "'s", "é", "世", "1", "!", "<|endoftext|>", " the", " and", "\xa0", "\t", " zq", "'ll"]
    texts = ["", "a" * 3000, " " * 2000, "世" * 500, *("".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(600)), prose(2000, 4)]
    monkeypatch.setattr(bpe, "CUT_BITS", 1)
    monkeypatch.setattr(bpe, "LEAST_CHUNK", 1)
    tight = bpe.ChunkEncoder(BYTE, cache_bytes=5000)
    for t in texts:
        assert tight.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids
        assert tight.decode(tight.encode(t)) == t
    assert tight.reused and tight.cached <= 5000


def test_bpe_columns(spark):
    back = bpe.decode(bpe.encode(docs(spark, ["ab c", None, ""]).withColumn("ids", F.lit(1)), BYTE), BYTE).orderBy("doc_id").collect()
    assert [r["text"] for r in back] == ["ab c", "", ""] and back[0]["shard"] == "x"


def test_round_trip_is_encode_and_decode(spark):
    rows = docs(spark, ["ab c", None, "", "é 世界 <|endoftext|> the", prose(300, 1)])
    both = bpe.round_trip(rows, BYTE).orderBy("doc_id").collect()
    ids = bpe.encode(rows, BYTE).orderBy("doc_id").collect()
    assert [r["ids"] for r in both] == [r["ids"] for r in ids] and both[0]["shard"] == "x"
    assert [r["text"] for r in both] == [r["text"] for r in bpe.decode(bpe.encode(rows, BYTE), BYTE).orderBy("doc_id").collect()]


# --- 5 -------------------------------------------------------------------------------------
def test_warc(spark, tmp_path):
    page = "<p>" + "long " * 40
    rows = [(1, "http://a/1\r\nx", page), (2, None, page), (3, "http://a/3", "tiny"), (4, "http://a/4", "tiny"), (5, "http://b/5", None), (6, "http://a/6", "é" * 90_000), (7, "u", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    uri = f"file://{tmp_path}/w"
    back = {r["record_id"]: r for r in warc.archive_pages(pages, uri).collect()}
    assert len(back) == 7 and bytes(back["<urn:page:6>"]["payload"]).decode() == rows[5][2]
    assert back["<urn:page:7>"]["record_type"] == "revisit" and back["<urn:page:7>"]["refers_to"] == "<urn:page:1>" and back["<urn:page:7>"]["payload"] is None
    assert back["<urn:page:4>"]["record_type"] == "response" and back["<urn:page:1>"]["payload_length"] == len(page)
    for split in ("300", "5000"):
        assert warc.read_warc(spark, uri, splitBytes=split).count() == 7
    picked = warc.read_warc(spark, uri, payload="none").where("record_type = 'response' and target_uri like 'http://a/%'")
    assert sorted((r["record_id"], r["payload"]) for r in picked.collect()) == [(f"<urn:page:{k}>", None) for k in (1, 3, 4, 6)]
    assert warc.archive_pages(pages.limit(0), f"file://{tmp_path}/none").count() == 0


def test_foreign_archives(spark, tmp_path):
    records = [warc.make_record({"record_type": "response", "record_id": f"<{k}>", "warc_date": "d", "target_uri": "u", "refers_to": None, "payload_digest": None, "payload": b"x" * k, "payload_length": k}) for k in (0, 5, 9000)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    got = warc.read_warc(spark, str(tmp_path)).select("record_id", F.octet_length("payload").alias("n")).collect()
    assert sorted((r["record_id"], r["n"]) for r in got) == sorted([("<0>", 0), ("<5>", 5), ("<9000>", 9000)] * 2)


def records(n, payload=b"the payload " * 30):
    digest = "sha256:" + hashlib.sha256(payload).hexdigest()
    fields = {"record_type": "response", "warc_date": "d", "target_uri": "u", "refers_to": None, "payload_digest": digest, "payload": payload, "payload_length": len(payload)}
    return [warc.make_record(fields | {"record_id": f"<{k}>"}) for k in range(n)]


def read_all(path, **options):
    reader = warc.WarcReader({"path": str(path.parent), **options})
    return [r for part in reader.partitions() for batch in reader.read(part) for r in batch.to_pylist()]


@pytest.mark.parametrize("kind", ["own", "foreign", "plain"])
def test_archives_cut_anywhere_end_with_an_error_or_a_row(tmp_path, kind):
    pack = {"own": warc.pack_member, "foreign": gzip.compress, "plain": bytes}[kind]
    first, last = (pack(r) for r in records(2))
    path = tmp_path / ("a.warc" if kind == "plain" else "a.warc.gz")
    path.write_bytes(first + last)
    assert len(read_all(path)) == 2
    end = len(last) - (4 if kind == "plain" else 0)  # A plain record may lack its last empty lines.
    for size in range(1, end):
        path.write_bytes(first + last[:size])
        for options in ({}, {"payload": "none"}):
            with pytest.raises(ValueError, match="corrupt WARC record in .* at offset"):
                read_all(path, **options)
        assert [r["record_type"] for r in read_all(path, corrupt="row")] == ["response", "corrupt"]


@pytest.mark.parametrize("kind", ["own", "foreign", "plain"])
def test_flipped_bytes_are_found_and_reading_goes_on(tmp_path, kind):
    pack = {"own": lambda r: warc.pack_member(r, 0), "foreign": lambda r: gzip.compress(r, 0), "plain": bytes}[kind]
    a, b, c = (pack(r) for r in records(3))
    at = b.index(b"the payload") + 40
    path = tmp_path / ("a.warc" if kind == "plain" else "a.warc.gz")
    path.write_bytes(a + b[:at] + b"#" + b[at + 1 :] + c)
    with pytest.raises(ValueError, match="corrupt"):
        read_all(path)
    rows = read_all(path, corrupt="row")
    assert [r["record_type"] for r in rows] == ["response", "corrupt", "response"]
    assert dict(rows[1]["headers"])["Offset"] == str(len(a)) and rows[2]["record_id"] == "<2>"
    path.write_bytes(b"no archive at all" * 9)
    assert [r["record_type"] for r in read_all(path, corrupt="row")] == ["corrupt"]


def test_warc_ids_that_are_null_or_repeated(spark, tmp_path):
    page = "<p>" + "long " * 40
    rows = [(None, "u", page, "x"), (3, "u", page, "x"), (3, "u", page, "x"), (4, "v", page, "x"), (None, "u", None, "x"), (None, "w", page + "!", "x"), (None, "w", page + "!", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    back = warc.archive_pages(pages, f"file://{tmp_path}/w").collect()
    got = sorted((r["record_id"], r["record_type"], r["refers_to"] or "") for r in back)
    one, none = "<urn:page:3>", "<urn:page:none>"
    assert got == sorted([(none, "revisit", one), (one, "response", ""), (one, "response", ""), ("<urn:page:4>", "revisit", one), (none, "response", ""), (none, "response", ""), (none, "response", "")])


# --- 6 -------------------------------------------------------------------------------------
def test_quality(spark):
    good = "\n".join(prose(12, k) + "." for k in range(6))
    texts = [good, good + "\nAll rights reserved", "a | b | c | d | e\n" * 20 + good[:100], "buy now cheap\n" * 40, "", None, "word " * 10, prose(80, 9).replace(" ", "### ")]
    got = {r["doc_id"]: r for r in quality.clean_and_judge(docs(spark, texts)).collect()}
    assert [got[k]["kept"] for k in range(1, 9)] == [True, True, False, False, False, False, False, False]
    assert got[2]["clean_text"] == good and got[2]["n_failed_lines"] == 1 and got[6]["clean_text"] is None
    for k, t in enumerate(texts, 1):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in (i, i + 1, i + 2)}
        assert (got[k]["n_words"], got[k]["n_repeat_words"]) == (len(w), len(hit))
    kept = quality.clean_and_judge(docs(spark, texts), passthrough=True)
    assert kept.columns == ["doc_id", "text", "shard", "n_words", "clean_text", "base_failed", "kept"]


# --- 7 -------------------------------------------------------------------------------------
@pytest.mark.parametrize("most", [decontaminate.MAX_NODES, 200, 35])
def test_decontamination(spark, most):
    item = [f"w{i}" for i in range(14)]
    bench = spark.createDataFrame([(7, " ".join(item)), (10, "Tiny ITEM"), (11, None), (12, "!!"), (7, " ".join(item)), (None, "no id")], "item_id long, text string")
    texts = ["x, W0 w1-w2 w3 w4 w5 w6 w7 w8 w9! y", " ".join(item[:9]), "a tiny  item é", "", None, " ".join(item) + " tiny item", "no id, tiny item"]
    found = decontaminate.find_contamination(docs(spark, texts), bench, ["doc_id"], with_text=True, max_nodes=most)
    got = {r["doc_id"]: r for r in found.collect()}
    covered = [sorted({p for x in got[k]["ranges"] for p in range(x["start"], x["end"])}) for k in range(1, 8)]
    assert covered == [list(range(1, 11)), [], [1, 2], [], [], list(range(16)), [0, 1, 2, 3]]
    assert got[6]["items"] == ["10", "7"] and got[1]["clean_text"] == "x, ! y" and got[3]["clean_text"] == "a  é" and got[5]["clean_text"] is None
    assert got[7]["items"] == ["10", None] and got[4]["items"] == [] and got[1]["n_words"] == 12


def test_automata_are_bounded_by_their_nodes():
    rng = random.Random(4)
    bench = [(k, " ".join(prose(1, rng.randrange(400)) for _ in range(rng.randint(1, 300)))) for k in range(20)]

    class Rows:
        def toLocalIterator(self):
            return iter({"item_id": str(k), "text": t} for k, t in bench)

    slices = list(decontaminate._slices(Rows(), 10, 3000))
    nodes = [decontaminate.build(part, 10).get_stats()["nodes_count"] for part in slices]
    assert len(nodes) > 5 and max(nodes) <= 3001
    windows = {(k, w) for k, t in bench for w in decontaminate.windows_of(decontaminate.normal_words(t), 10)}
    assert windows == {(int(k), w) for part in slices for k, t in part for w in decontaminate.windows_of(t.split(), 10)}


# --- 8 -------------------------------------------------------------------------------------
def test_restorer_reads_leetspeak():
    counts = np.zeros(toxicity.CLASSES**3, np.int64)
    toxicity.trigram_counts("idiot moron the cat sat on the mat loser pathetic " * 50, counts)
    r = toxicity.Restorer(counts.astype(float))
    assert [r.restore(w) for w in ("1d10t", "m0r0n", "idiooot", "p@thetic", "l0$er")] == ["idiot", "moron", "idiot", "pathetic", "loser"]
    assert {"idiot", "moron"} <= toxicity.words_of("you i d i o t and m.o.r.o.n", r)


def english():
    """A restorer that has read a few sentences."""
    counts = np.zeros(toxicity.CLASSES**3)
    toxicity.trigram_counts("you idiot. you are a stupid idiot, such a toxic shit, what an arse. you are the worst idiot of them all, are you not? " * 50, counts)
    return toxicity.Restorer(counts)


def test_restorer_finds_the_cheapest_reading_of_the_lattice():
    r, rng = english(), random.Random(6)

    def cost(letters):
        x, y, total = 0, 0, 0.0
        for c in [*letters, None]:
            z = 0 if c is None else int(toxicity._TABLE[ord(c)])
            total, x, y = total + r.cost[x][y][z], y, z
        return total

    for _ in range(150):
        token = "".join(rng.choice("aiot1035@!$*. -t") for _ in range(rng.randint(1, 7))).strip(" .-_")
        readings = {}
        for path in itertools.product(*r.lattice(token)):
            said = "".join(letters for letters, _ in path)
            readings[said] = min(readings.get(said, 1e9), sum(extra for _, extra in path) + cost(said))
        assert readings[r.restore(token)] <= min(readings.values()) + 1e-9, token


def test_trigrams_count_over_the_cuts_of_a_long_text(monkeypatch):
    text = " ..Ab c,  deé " * 7 + "世x"
    whole, parts = np.zeros(toxicity.CLASSES**3, np.int64), np.zeros(toxicity.CLASSES**3, np.int64)
    toxicity.trigram_counts(text, whole)
    for piece in (1, 2, 5):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        parts[:] = 0
        toxicity.trigram_counts(text, parts)
        assert np.array_equal(whole, parts)


def test_leet_words_of_a_text_are_restored():
    found = toxicity.words_of("you 1d10t, 5h17 and (70x1c) 4r53!", english())
    assert {"idiot", "shit", "toxic", "arse"} <= found


def test_words_of_any_length_and_gaps_are_restored():
    r = english()
    long_text = " you are the worst of them all " * 30
    assert "idiot" in toxicity.words_of(long_text + "you i. d. i. o. t", r)
    assert {"you", "idiot"} <= toxicity.words_of("y o u  i d i o t", r) & toxicity.words_of("y o u i d i o t", r)
    assert "idiot" in toxicity.words_of("you.are." * 20 + "1d10t", r)
    assert r.restore("1d10t-" * 50_000).split() == ["idiot"] * 50_000


def test_toxicity_holds_out(spark):
    rows = [(k, prose(40, k) + (" you scum loser" if k % 3 == 0 else "")) for k in range(400)]
    table = spark.createDataFrame([*rows, (400, "you 5cum l0ser " + prose(20, 77)), (401, ""), (402, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, toxic int")
    # An id that very many rows share is learnt from once.
    table = table.union(spark.createDataFrame([(1, "you scum loser " + prose(30, 5))] * 400, "doc_id long, text string"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(table, labels).collect()}
    right = sum((got[k] >= 0.5) == (k % 3 == 0) for k in range(300, 400))
    assert right >= 98 and got[400] >= 0.5 and got[401] == got[402] < 0.5


# --- 9 -------------------------------------------------------------------------------------
def test_token_counts(spark):
    library, rng = Tokenizer.from_file(WORD), random.Random(1)
    alphabet = "aB'sS <|é\xa0ſıŉ²1\x1c\x85\tÿµß\"!x\n\x00Þ世İ"
    texts = ["", None, "don't <|endoftext|> STOP", *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(400)), "“quoted” – don’t 世界 and 世界 plain words … " * 30, "x" * 5000 + " Å ﬁ Kelvin é", prose(3000, 2)]
    got = {r["doc_id"]: r for r in tokencount.count_tokens(docs(spark, texts), WORD).collect()}
    for k, t in enumerate(texts, 1):
        assert got[k]["n_tokens"] == len(library.encode(t or "", add_special_tokens=False).ids), repr(t)
        assert got[k]["n_bytes"] == len((t or "").encode())
    assert got[len(texts)]["over_limit"]


def test_frequent_pre_tokens_of_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(tokencount, "TABLE", 3)
    words, lengths = tokencount.frequent_lengths(docs(spark, ["qxzqxzqxz Hello you " * 9, "hello rare", "you qxzqxzqxz", None, ""]).select("text"), WORD)
    library = Tokenizer.from_file(WORD)
    assert words.decode().split() == ["hello", "qxzqxzqxz", "you"] and list(lengths) == [len(library.encode(w).ids) for w in words.decode().split()]
    count = tokencount.counter(WORD, (words, lengths))
    assert count("you rare hello “rare” rare") == len(library.encode("you rare hello “rare” rare").ids)
    lengths_of = next(iter(tokencount._lengths_of.values()))
    assert lengths_of[1].missed == 1 and list(lengths_of[2]) == ["“rare”"]
    seen = tokencount.Frequent(2)
    for k in range(50):
        seen.update(["a", "a", "b", f"c{k}"])
    assert seen.top()[:2] == [("a", 100), ("b", 50)] and len(seen.counts) <= 5


# --- 10 ------------------------------------------------------------------------------------
def test_url_rules_and_words(spark):
    rows = [("HTTP://X.Example.NET/en/a", "example.net/en/", "allow"), ("http://example.net/de/", "net/", "block"), ("http://example.net", None, None), ("https://a.example.com/de/x?y", "example.com/de/", "block"), ("http://b.org/fr/1#z", "org/fr/", "allow"), ("http://borg/fr/", None, None), (None, None, None), ("no scheme", None, None), ("http://", None, None), ("http://cheap-pills.com/x", None, "block"), ("http://cheappills.com/x", None, "block"), ("http://garden.com/x", None, "allow")]
    more = [("http://cheap-pills.com/en/1", None, None)] * 4 + [("http://garden-club.com/en/2", None, None)] * 40
    df = spark.createDataFrame([(k, u, "<title>the garden club</title>") for k, (u, _, _) in enumerate(rows + more)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in urlfilter.judge_urls(df).collect()}
    for k, (_, rule, verdict) in enumerate(rows):
        assert got[k]["rule"] == rule and verdict in (None, got[k]["verdict"]), rows[k]
    assert (got[0]["host"], got[0]["path"], got[6]["host"], got[7]["path"]) == ("x.example.net", "/en/a", "", "")


def test_empty_tables(spark):
    none = docs(spark, [])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert minhash.near_duplicates(none).count() == 0 and linededup.remove_shared_passages(none).count() == 0
    assert decontaminate.find_contamination(none, bench, ["doc_id"]).count() == 0 and toxicity.score_toxicity(none, labels).count() == 0
    assert quality.clean_and_judge(none).count() == 0 and tokencount.count_tokens(none, WORD).count() == 0


def test_rare_words_split_hosts_beside_many_frequent_ones(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = " ".join("q" + "".join(letters[k // 26**i % 26] for i in range(4)) for k in range(51_000))
    urls = spark.createDataFrame([("buyviagra.example.org", "/"), ("bestcasino.example.org", "/")], "host string, path string")
    titles = spark.createDataFrame([("Buy best viagra",), (many,), (many,)], "title string")
    words = urlfilter.host_words(urls.select("host").distinct(), urlfilter.count_words(urls, titles))
    got = {r["host"]: r["words"] for r in words.collect()}
    assert got["buyviagra.example.org"][:2] == ["buy", "viagra"] and got["bestcasino.example.org"][:2] == ["best", "casino"]


def test_names_are_split_at_the_least_cost():
    rng = random.Random(12)
    for _ in range(150):
        counts = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): rng.randint(1, 50) for _ in range(rng.randint(0, 12))}
        name, total = "".join(rng.choice("abc") for _ in range(rng.randint(1, 8))), sum(counts.values()) + 1
        cost = lambda words: sum(math.log(total / counts[w]) if w in counts else math.log(total * 10) + 2.3 * len(w) for w in words)  # noqa: B023, E731
        ways = [[name[i:j] for i, j in itertools.pairwise([0, *cut, len(name)])] for k in range(len(name)) for cut in itertools.combinations(range(1, len(name)), k)]
        got = urlfilter.segment(name, counts, total)
        assert "".join(got) == name and abs(cost(got) - min(map(cost, ways))) < 1e-9
    assert urlfilter.segment("a" * 60, {"a" * 60: 1}, 5) == ["a" * 60]


@pytest.mark.parametrize("large", [urlfilter.LARGE, 3])
def test_url_scores_are_plain_naive_bayes(spark, monkeypatch, large):
    monkeypatch.setattr(urlfilter, "LARGE", large)
    hosts, paths = ["cheap-pills.com", "cheappills.net", "garden.org", "garden-club.com", "poker7.de", "", "gardenclub.com"], ["/", "/en/1", "/shop/Pills", "/garden/7/b", ""]
    rng = random.Random(3)
    rows = [(k, "garden.org" if k % 3 == 0 else rng.choice(hosts), rng.choice(paths)) for k in range(120)]
    urls = spark.createDataFrame(rows, "page_id long, host string, path string")
    titles = spark.createDataFrame([("The garden club",), ("Cheap shop",), (None,)], "title string")
    got = {r["page_id"]: r["score"] for r in urlfilter.score_urls(urls, titles).collect()}
    counts = collections.Counter(urlfilter.SEEDS)
    for _, h, p in rows:
        counts.update(x for x in re.split(r"[^a-zA-Z]+", f"{h if '-' in h else ''} {p}") if x)
    counts.update("the garden club cheap shop".split())
    held, docs_, told = {0: collections.Counter(), 1: collections.Counter()}, [0, 0], {}
    for k, h, p in rows:
        words = [w for part in re.findall(r"[a-z]+|\d+", h) for w in (["#"] if part.isdigit() else urlfilter.segment(part, counts, sum(counts.values())))]
        tokens = words + ["/" + ("#" if x.isdigit() else x.lower()) for x in re.findall(r"[a-zA-Z]+|\d+", p)]
        label = int(any(w in urlfilter.SEEDS for w in words))
        told[k] = tokens
        docs_[label] += 1
        held[label].update(tokens)
    v, totals = len(held[0] | held[1]), [sum(held[x].values()) for x in (0, 1)]
    weigh = lambda t: math.log((held[1][t] + 0.1) / (totals[1] + 0.1 * v)) - math.log((held[0][t] + 0.1) / (totals[0] + 0.1 * v))
    for k, tokens in told.items():
        assert abs(got[k] - math.log((docs_[1] + 1) / (docs_[0] + 1)) - sum(map(weigh, tokens))) < 1e-9
    assert len(got) == len(rows) and len(set(map(bool, [s > 0 for s in got.values()]))) == 2
