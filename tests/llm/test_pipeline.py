"""The pipeline, and line dedup, against brute-force versions in plain Python."""

import hashlib
import random
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lodestone.llm.quality import BOILERPLATE, CLOSING, NAVIGATION

SPACE = " \t\n\x0b\x0c\r"
worded = lambda line: line.strip(SPACE) != ""
split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    line = lambda n: " ".join(word() for _ in range(n)) + "."
    passages = [line(60) for _ in range(3)]
    item = [word() for _ in range(15)]
    texts = []
    for k in range(40):
        lines = [line(rng.randint(8, 25)) for _ in range(rng.randint(4, 9))]
        if k % 4 == 0:
            lines.insert(rng.randrange(len(lines)), passages[k % 3])
        if k % 5 == 0:
            lines.append("All rights reserved")
        if k % 9 == 0:
            lines[0] += " " + " ".join(item) + "."
        texts.append("\n".join(lines))
    near = texts[1].split(" ")
    near[7], near[40] = "changed", "too"
    junk = " | ".join(word() for _ in range(80))
    texts += [texts[2], texts[2], " ".join(near).replace("\n", " "), texts[1].replace("\n", " "), "short text", junk, "", "same words here " * 40]
    return [(k, t, "en", f"src{k % 3}", len(t)) for k, t in enumerate(texts)], [(1, " ".join(item)), (2, "nothing of this " + line(12))]


def brute_quality(rows):
    def bad(line):
        bare = line.strip(SPACE)
        low, n = bare.lower(), bare.count(" ") + 1
        symbols, shouts = sum(c in "#*$%&|<>{}" for c in line), len(re.findall(r"[!?]{2,}(?:[\x20\x09-\x0D]|\Z)", line))
        bars = line.count("|")
        furniture = any(p in low for p in BOILERPLATE) or low in NAVIGATION or (bars >= 3 and bars * 4 >= n)
        return worded(line) and (furniture or symbols > len(line) * 0.1 or (shouts > 0 and shouts * 5 >= n) or (n >= 10 and bare[-1] not in CLOSING))

    size = lambda s: sum(c not in SPACE for c in s)
    out = {}
    for k, text in rows.items():
        w, lines = split(text), [x for x in text.split("\n") if worded(x)]
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in (i, i + 1, i + 2)}
        lost = sum(size(x) for x in lines if bad(x))
        if len(w) >= 50 and 100 * len(hit) <= 50 * len(w) and lost <= size(text) * 0.3 and 2 * (len(lines) - len(set(lines))) <= len(lines):
            out[k] = "\n".join(x for x in text.split("\n") if not bad(x))
    return out


def brute_lines(rows, least=20):
    lines = {k: [x for x in t.split("\n") if worded(x)] for k, t in rows.items()}
    gone = {k: set() for k in rows}
    for later in rows:
        own = lines[later]
        for other in (lines[k] for k in rows if k < later):
            for a in range(len(own)):
                for e in range(len(other)):
                    n = 0
                    while a + n < len(own) and e + n < len(other) and own[a + n] == other[e + n]:
                        n += 1
                    if sum(x.count(" ") + 1 for x in own[a : a + n]) >= least:
                        gone[later].update(range(a, a + n))
    out = {}
    for k, text in rows.items():
        place, kept = -1, []
        for x in text.split("\n"):
            place += worded(x)
            if not (worded(x) and place in gone[k]):
                kept.append(x)
        if not gone[k] or len(gone[k]) < len(lines[k]):
            out[k] = "\n".join(kept) if gone[k] else text
    return out


def brute_near(rows, n=5, percent=80):
    sets = {}
    for k, t in rows.items():
        w = split(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    group = {k: k for k in rows}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = sorted((group[a], group[b]))
                group = {k: x if g == y else g for k, g in group.items()}
    return {k: t for k, t in rows.items() if group[k] == k}


def brute_leaks(rows, items):
    words = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if w]
    windows = set()
    for _, t in items:
        w = words(t)
        windows |= {" ".join(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    return {k: t for k, t in rows.items() if not any(f" {w} " in f" {' '.join(words(t))} " for w in windows)}


def test_pipeline_equals_brute_force(spark, tmp_path):
    table, items = corpus()
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r[0]: r[1] for r in table}
    for step in (brute_quality, brute_lines, brute_near, lambda rows: brute_leaks(rows, items)):
        before, want = want, step(want)
        assert want != before
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {k: r["text"] for k, r in got.items()} == want
    assert all(r["exact"] and r["n_tokens"] == len(library.encode(r["text"], add_special_tokens=False).ids) for r in got.values())


def odd_rows():
    """Ids that are null or repeated, texts that are null, blank, equal or nearly equal."""
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abcdefghij") * rng.randint(2, 8) + str(rng.randrange(99)) for _ in range(n)) + "."
    one, two, three, four = (text(80) for _ in range(4))
    near = one.split(" ")
    near[3] = "changed"
    rows = [(5, one), (3, two), (3, three), (3, three), (None, one), (None, four), (None, four), (7, four), (8, " ".join(near)), (8, two), (9, None), (9, None), (None, None), (10, ""), (10, " \n"), (2, "x " * 60), (11, three)]
    return [(k, t, "en", None, None if t is None else len(t)) for k, t in rows]


def test_near_dedup_of_odd_ids_and_texts(spark):
    rows = odd_rows()
    for table in (rows, [r for r in rows if r[0] not in (None, 3, 8, 9, 10)]):
        df = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
        single = sorted(set(table), key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest() if r[1] is not None else ""))
        left = brute_near({k: r[1] or "" for k, r in enumerate(single)})
        got = corpus_pipeline.near_dedup(spark, df, "")
        assert got.columns == list(corpus_pipeline.COLUMNS)
        assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr(r) for k, r in enumerate(single) if k in left)


def test_all_stages_take_odd_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (odd_rows(), []):
        df = spark.createDataFrame([(*r, "x") for r in table], "doc_id long, text string, lang string, source string, n_chars long, n_words string")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, str(tmp_path))
            rows = out.collect()
            assert name == "encoding" or out.columns == list(corpus_pipeline.COLUMNS)
            if name in ("decontamination", "encoding"):
                assert len(rows) == len(table)
            if name == "line_dedup":
                assert sum(r["doc_id"] is None for r in rows) == sum(r[0] is None for r in table)


def test_encoding_takes_one_python_worker_a_task(spark):
    # Each Python step of a stage is a worker of its own in every task that runs, and holds the vocabulary.
    docs = spark.createDataFrame([(1, "ab c", "en", "s", 4)], "doc_id long, text string, lang string, source string, n_chars long")
    plan = corpus_pipeline.encoding(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
