"""URL filtering: host rules first, then naive Bayes over segmented names."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import materialise

# The rules as (action, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Words that mark a host as unwanted in the training of the classifier.
SEEDS = frozenset("adult ads bets betting casino escort gambling pills poker porn spam track tracker viagra warez xxx".split())
#: Words have at most so many letters, as the labels of a host have.
LONGEST = 63
#: A key of at least 1 / LARGE of all rows is a large one.
LARGE = 1024
#: What is added to each token's count in both classes.
SMOOTHING = 0.1


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("url"))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits as ``(rule, action)``, null where none does."""
    rule = action = F.lit(None).cast("string")
    for act, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, action = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def segment(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest words of a concatenated name under a unigram model (Viterbi).

    A word costs the logarithm of its rarity. An unknown word costs more than any
    known one, and more with each letter; ties go to the longer last word.
    """
    unknown = math.log(total * 10)
    best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for start in range(max(0, end - LONGEST), end):
            n = counts.get(name[start:end])
            cost = best[start] + (math.log(total / n) if n else unknown + 2.3 * (end - start))
            if cost < best[end]:
                best[end], back[end] = cost, start
    words, end = [], len(name)
    while end:
        words.append(name[back[end] : end])
        end = back[end]
    return words[::-1]


def parts_of(text: Column) -> Column:
    """Runs of letters and runs of digits, in order."""
    return F.regexp_extract_all(text, F.lit(r"(\p{L}+|\d+)"), F.lit(1))


def is_number(part: Column) -> Column:
    return F.rlike(part, F.lit(r"^\d"))


def path_tokens(path: Column) -> Column:
    return F.transform(parts_of(path), lambda x: F.concat(F.lit("/"), F.when(is_number(x), F.lit("#")).otherwise(F.lower(x))))


def count_words(urls: DataFrame, texts: DataFrame) -> DataFrame:
    """Words and their counts in all titles, in paths, and in hosts that part their words with hyphens; each of SEEDS once more."""
    pieces = F.split(F.concat_ws(" ", F.when(F.col("host").contains("-"), F.col("host")), F.col("path")), r"[^\p{L}]+")
    said = urls.select(F.explode(pieces).alias("w")).union(texts.select(F.explode(F.split(F.lower("title"), r"[^\p{L}]+")).alias("w")))
    seeds = urls.sparkSession.createDataFrame([(w,) for w in sorted(SEEDS)], "w string")
    return said.where(F.length("w").between(1, LONGEST)).union(seeds).groupBy("w").agg(F.count("*").alias("n"))


def host_words(hosts: DataFrame, counted: DataFrame) -> DataFrame:
    """``(host, words)`` of distinct ``hosts (host)``: names split into words, numbers as ``#``.

    Each distinct name meets those counted words that stand in it, by a join on its
    substrings, and is split by itself with them: the model of all words is neither
    collected nor broadcast, whatever its size, and no word is left out.
    """
    total = counted.agg(F.sum("n")).first()[0] or 1
    placed = materialise(hosts.select("host", F.posexplode(parts_of(F.col("host"))).alias("at", "name")), "host-parts")
    names = placed.where(~is_number(F.col("name"))).select("name").distinct()
    starts = names.select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("at"))
    inside = starts.select("name", F.explode(F.expr(f"transform(sequence(1, least({LONGEST}, length(name) - at + 1)), n -> substring(name, at, n))")).alias("w")).distinct()
    known = inside.join(counted.hint("merge"), "w").groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("w", "n"))).alias("known"))

    @F.pandas_udf("array<string>")
    def split(name: pd.Series, known_: pd.Series) -> pd.Series:
        return pd.Series([segment(n, dict(k) if k is not None else {}, total) for n, k in zip(name, known_, strict=True)], dtype=object)

    split_names = materialise(names.join(known, "name", "left").select("name", split("name", "known").alias("words")), "split-names")
    words = F.when(is_number(F.col("name")), F.array(F.lit("#"))).otherwise(F.col("words"))
    told = placed.join(split_names, "name", "left").select("host", F.struct("at", words.alias("words")).alias("p"))
    return told.groupBy("host").agg(F.flatten(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["words"])).alias("words"))


def token_weights(tokens: DataFrame) -> DataFrame:
    """``(token, weight)`` of counts ``(label, token, n)``: log-odds of multinomial naive Bayes, smoothed."""
    both = tokens.groupBy("token").agg(*[F.coalesce(F.sum(F.when(F.col("label") == k, F.col("n"))), F.lit(0)).alias(f"n{k}") for k in (0, 1)])
    both = materialise(both, "token-counts")
    v, t0, t1 = both.agg(F.count("*"), F.coalesce(F.sum("n0"), F.lit(0)), F.coalesce(F.sum("n1"), F.lit(0))).first()
    share = lambda n, t: F.log((F.col(n) + SMOOTHING) / F.lit(t + SMOOTHING * max(v, 1)))
    return both.select("token", (share("n1", t1) - share("n0", t0)).alias("weight"))


def join_by(rows: DataFrame, known: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with what is ``known`` of their key, which has one row and a number of rows ``n`` for each.

    At most LARGE keys hold 1 / LARGE of all rows each: these reach their rows by
    broadcast, so that no key is hot, and all others by a merge join.
    """
    large = F.col("n") * LARGE >= total
    columns = [c for c in known.columns if c not in (key, "n")]
    near = F.broadcast(known.where(large).select(F.col(key), F.struct(*columns).alias("_known")))
    marked = rows.join(near, key, "left")
    far = known.where(~large).select(key, F.struct(*columns).alias("_known")).hint("merge")
    rest = marked.where("_known is null").drop("_known").join(far, key)
    return marked.where("_known is not null").unionByName(rest).select(*rows.columns, "_known.*")


def score_urls(urls: DataFrame, texts: DataFrame) -> DataFrame:
    """``urls (page_id, host, path)`` with ``score``, the log-odds that a url is unwanted.

    Multinomial naive Bayes over the words of the host and the tokens of the path.
    Labels come from the segmented host: 1 where a word is one of SEEDS. Counts, weights
    and scores are kept by token, host and path in tables, exactly and without a bound.
    """
    total = urls.count()
    counted = materialise(count_words(urls, texts), "words")
    hosts = urls.groupBy("host").agg(F.count("*").alias("n"))
    words = materialise(hosts.join(host_words(hosts.select("host"), counted), "host", "left").select("host", "n", F.coalesce("words", F.array().cast("array<string>")).alias("words")), "host-words")
    label = F.arrays_overlap("words", F.array(*map(F.lit, sorted(SEEDS)))).cast("int")
    labelled = materialise(words.select("host", "n", label.alias("label")), "labels")
    paths = materialise(join_by(urls.select("host", "path"), labelled, "host", total).groupBy("path", "label").agg(F.count("*").alias("n")), "paths")
    tokens = words.select(label.alias("label"), F.explode("words").alias("token"), "n").union(paths.select("label", F.explode(path_tokens(F.col("path"))), "n"))
    weights = materialise(token_weights(tokens.groupBy("label", "token").agg(F.sum("n").alias("n"))), "weights")
    seen = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    prior = math.log((seen.get(1, 0) + 1) / (seen.get(0, 0) + 1))

    def summed(keyed: DataFrame, key: str, name: str) -> DataFrame:
        """The weights of each key's tokens, added in one fixed order."""
        found = keyed.select(key, F.explode("tokens").alias("token")).join(weights, "token").groupBy(key).agg(F.array_sort(F.collect_list("weight")).alias("w"))
        add = F.aggregate(F.coalesce("w", F.array().cast("array<double>")), F.lit(0.0), lambda x, y: x + y)
        return materialise(keyed.join(found, key, "left").select(key, "n", add.alias(name)), name)

    by_host = summed(words.select("host", "n", F.col("words").alias("tokens")), "host", "of_host")
    by_path = summed(paths.groupBy("path").agg(F.sum("n").alias("n")).withColumn("tokens", path_tokens(F.col("path"))), "path", "of_path")
    scored = join_by(join_by(urls, by_host, "host", total), by_path, "path", total)
    return scored.withColumn("score", F.lit(prior) + F.col("of_host") + F.col("of_path")).drop("of_host", "of_path")


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """Judge every url: ``page_id, host, path, rule, verdict, score``.

    The longest fitting rule decides; where none fits, multinomial naive Bayes
    over the words of the host (split by unigram Viterbi) and the path's tokens
    does: ``block`` for a positive log-odds ``score`` (:func:`score_urls`). The model is
    fitted on all rows of ``pages`` and stays in tables.

    Null urls and urls without ``://`` have an empty host and path and fit no
    rule. Urls of any length are read whole. Of rules of equal length the last in
    order of host and action decides. Repeated rows get equal answers; an empty table
    gives no rows; other columns are not read.
    """
    host, path = split_url(F.col("url"))
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    urls = base.select("page_id", host.alias("host"), path.alias("path"))
    titles = pages.select(F.regexp_extract(F.coalesce(F.col(html_col).cast("string"), F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"))
    scored = score_urls(materialise(urls, "urls"), titles)
    rule, action = matching_rule(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(action, F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "score")
