"""Toxicity scores of deobfuscated text."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import materialise

#: Labelled rows that the classifier is fitted on at most, those with the smallest hashes of their ids.
MAX_TRAIN = 20_000
#: Hashed places of word features.
PLACES = 1 << 20
#: Character classes of the language model: 0 is a word's edge, 1 to 26 are a to z, the rest are other letters.
CLASSES = 64

# What letters an obfuscating character may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "*": "aeiou",
}
_LEET_COST, _REPEAT_COST = 0.5, 0.3
# A gap as narrow as any that is a space after all, and a wider one that is none.
_SPACE_COST, _WIDE_COST = 1.5, 2.0

_WORD = re.compile(r"[^\W\d_]+")
_SPACED = re.compile(r"(?<![\w@$])(?:[\w@$][ .\-_*]{1,2}){2,}[\w@$](?![\w@$])")
_REPEATED = re.compile(r"([^\W\d_])\1\1")
_EDGES = ".,;:!?\"'()[]<>#&%~"
_MASKS = re.compile("[" + re.escape("".join(LEET)) + "]")
_LETTER = re.compile(r"[^\W\d_]")
_GAP_CHARS = " .-_"
_GAP = re.compile(r"[ .\-_]+")
_GAPS = str.maketrans("", "", _GAP_CHARS)


def _class_table() -> np.ndarray:
    table = np.zeros(0x250, np.uint8)
    for code in range(0x250):
        c = chr(code)
        if c.isalpha():
            table[code] = ord(c) - 96 if "a" <= c <= "z" else 27 + code % 35
    return table


_TABLE = _class_table()


def classes_of(text: str) -> np.ndarray:
    """Character classes of a lower-cased text, 0 for what is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    return np.where(codes < len(_TABLE), _TABLE[np.minimum(codes, len(_TABLE) - 1)], 62).astype(np.int64)


#: Texts are counted in pieces of so many characters; the trigrams over a cut count too.
PIECE = 1 << 20


def trigram_counts(text: str | None, into: np.ndarray) -> None:
    """Add a text's character trigrams to the CLASSES ** 3 counts; runs of non-letters are one
    edge, which also stands before and behind the text. Bounded memory for any length."""
    last = np.zeros(1, np.int64)
    for at in range(0, len(text or ""), PIECE):
        end = at + PIECE >= len(text)
        k = np.concatenate([last, classes_of(text[at : at + PIECE]), np.zeros(int(end), np.int64)])
        k = k[np.concatenate([[True], (k[1:] > 0) | (k[:-1] > 0)])]
        if len(k) > 2:
            np.add(into, np.bincount((k[:-2] * CLASSES + k[1:-1]) * CLASSES + k[2:], minlength=len(into)), out=into)
        last = k[-2:]


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES**3, np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            trigram_counts("\n".join(t for t in batch.column(0).slice(at, 256).to_pylist() if t), total)
    where = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32)), pa.array(total[where])], names=["place", "n"])


class Restorer:
    """Viterbi decoder of obfuscated words under a character trigram model."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        cube = counts.reshape(CLASSES, CLASSES, CLASSES) + 0.01
        self.cost = (-np.log(cube / cube.sum(axis=2, keepdims=True))).tolist()
        self._short = lru_cache(200_000)(self._restore)

    def __reduce__(self):
        return Restorer, (self.counts,)

    @staticmethod
    def lattice(token: str) -> list[list[tuple[str, float]]]:
        """For each gap and each run of an equal character what it may stand for, with the channel's cost.

        A gap may be nothing or a space between words; one wider than the narrowest is rather a space.
        """
        steps = []
        narrow = min(map(len, _GAP.findall(token)), default=0)
        for m in re.finditer(r"[ .\-_]+|(.)\1*", token, re.S):
            c, n = m[1], m.end() - m.start()
            if c is None:
                wide = n > narrow
                steps.append([("", _WIDE_COST * wide), (" ", _SPACE_COST * (not wide))])
                continue
            plain = [(c, 0.0)] if c.isalpha() else [(x, _LEET_COST) for x in LEET.get(c, "")]
            options = [(x, cost + _REPEAT_COST * (n > 2)) for x, cost in plain]
            if n > 1:
                options += [(x * 2, 2 * cost + _REPEAT_COST * (n > 2)) for x, cost in plain]
            steps.append(options or [("", 1.0), (" ", 1.0)])
        return steps

    def restore(self, token: str) -> str:
        """The likeliest words, parted by spaces, of a token of any length; short ones are cached."""
        return (self._short if len(token) <= 64 else self._restore)(token)

    def _restore(self, token: str) -> str:
        decided: list[str] = []
        # A path is its cost and what it says, as a chain (chain before, letters).
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for options in self.lattice(token.lower().strip(_GAP_CHARS)):
            if len(best) == 1:
                # All paths agree so far: only what is undecided is held.
                state, (total, said) = next(iter(best.items()))
                decided.append(_unwind(said))
                best = {state: (total, None)}
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, said) in best.items():
                for letters, extra in options:
                    x, y, total = a, b, cost + extra
                    for c in letters:
                        code = ord(c)
                        z = int(_TABLE[code]) if code < len(_TABLE) else 62
                        # An edge has no second edge before it, so a word starts after one edge.
                        total += self.cost[x][y][z]
                        x, y = y, z
                    if (x, y) not in after or total < after[x, y][0]:
                        after[x, y] = total, (said, letters) if letters else said
            best = after
        ends = [(cost + self.cost[a][b][0], _unwind(said)) for (a, b), (cost, said) in best.items()]
        return "".join(decided) + min(ends)[1]


def _unwind(said: tuple | None) -> str:
    parts = []
    while said is not None:
        said, letters = said
        parts.append(letters)
    return "".join(parts[::-1])


def words_of(text: str | None, restorer: Restorer) -> set[str]:
    """Distinct lower-case words of a text, and what its obfuscated words restore to."""
    if not text:
        return set()
    words = set(_WORD.findall(text.lower()))
    odd = [w for w in words if len(w) > 2 and _REPEATED.search(w)]
    tokens = text.split()
    mixed = {t for t in tokens if not t.isalpha()}
    mixed = {t for t in {t.strip(_EDGES) for t in mixed} if len(t) > 2 and not t.isalpha()}
    for t in mixed:
        bare = t.translate(_GAPS)
        if _LETTER.search(bare) and (_MASKS.search(bare) or len(bare) > 2):
            odd.append(t)
    odd += set(_SPACED.findall(text))
    # What is written with gaps may be one word too, whatever spaces the model would rather read.
    readings = {*odd, *(t.translate(_GAPS) for t in odd)}
    return words.union(*(restorer.restore(t).split() for t in readings))


def features(word: str) -> list[int]:
    """Places of a word and of its beginnings of 3 to 6 letters."""
    return [zlib.crc32(f"{k}{word[:k]}".encode()) % PLACES for k in (3, 4, 5, 6) if len(word) > k] + [zlib.crc32(word.encode()) % PLACES]


STATS = 7


@dataclass
class Model:
    """What scoring needs: the restorer, weights of word features, and the last, logistic step."""

    restorer: Restorer
    weights: np.ndarray
    final: np.ndarray


def log_odds(positive: np.ndarray, negative: np.ndarray, n_positive: int, n_negative: int) -> np.ndarray:
    """Smoothed log-odds of a document's label given that it holds a feature; rare features say nothing."""
    odds = np.log((positive + 1) / (n_positive + 2)) - np.log((negative + 1) / (n_negative + 2))
    return np.where(positive + negative >= 5, odds, 0.0).astype(np.float32)


def word_scorer(weights: np.ndarray):
    @lru_cache(500_000)
    def of(word: str) -> float:
        return max(float(weights[p]) for p in features(word))

    return of


def stats(words: set[str], of) -> np.ndarray:
    """The document's evidence: constant, its three strongest words, the mean of five, the share of strong words, length."""
    top = sorted(map(of, words), reverse=True)
    strong = next((i for i, w in enumerate(top) if w < 1.5), len(top))
    padded = [max(w, 0.0) for w in top[:5]] + [0.0] * (5 - min(5, len(top)))
    return np.array([1.0, *padded[:3], sum(padded) / 5, 10 * strong / max(len(words), 10), np.log1p(len(words)) / 5])


def _words_batches(batches, restorer):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield part, [words_of(t, restorer) for t in part.column("text").to_pylist()]


def _count_features(restorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((4, PLACES), np.int32)
        for part, found in _words_batches(batches, restorer.value):
            for words, half, toxic in zip(found, part.column("half").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                places = np.unique([p for w in words for p in features(w)]).astype(np.int64)
                counts[2 * half + toxic, places] += 1
        group, place = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(group.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(counts[group, place].astype(np.int64))], names=["g", "place", "n"])

    return run


def _take_stats(restorer, halves):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [word_scorer(w) for w in halves.value]
        for part, found in _words_batches(batches, restorer.value):
            half = part.column("half").to_pylist()
            made = [stats(words, scorers[h]).tolist() for words, h in zip(found, half, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(made, pa.list_(pa.float64()))], names=["toxic", "stats"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w += np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Language model from all of ``docs``; classifier from at most ``max_train`` rows of ``labels (doc_id, toxic)``.

    The labelled sample has a fixed bound, so its ids are broadcast and no text
    is shuffled. Word weights are counted in two halves; the last step is fitted
    on evidence that each half takes from the other's weights.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    counts = np.zeros(CLASSES**3)
    for r in docs.select("text").mapInArrow(_count_trigrams, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[r["place"]] = r["n"]
    restorer = context.broadcast(Restorer(counts))

    mixed = F.xxhash64("doc_id")
    chosen = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("h", mixed)
    chosen = chosen.orderBy("h", "doc_id").limit(max_train).select("doc_id", "toxic", (F.pmod("h", F.lit(2))).cast("int").alias("half"))
    sample = spark.createDataFrame(chosen.collect(), "doc_id long, toxic int, half int")
    # One text an id, whatever the table holds, so that what is learnt from keeps its bound.
    train = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic", "half").agg(F.min("text").alias("text"))
    train = materialise(train.select("text", "toxic", "half"), "train")
    held = np.zeros((4, PLACES))
    for r in train.mapInArrow(_count_features(restorer), "g int, place int, n long").groupBy("g", "place").agg(F.sum("n").alias("n")).toLocalIterator():
        held[r["g"], r["place"]] = r["n"]
    sizes = np.zeros(4)
    for r in train.groupBy("half", "toxic").count().collect():
        sizes[2 * r["half"] + r["toxic"]] = r["count"]
    halves = context.broadcast([log_odds(held[2 * h + 1], held[2 * h], sizes[2 * h + 1], sizes[2 * h]) for h in (1, 0)])
    rows = train.mapInArrow(_take_stats(restorer, halves), "toxic int, stats array<double>").collect()
    final = np.zeros(STATS)
    if rows:
        final = logistic(np.array([r["stats"] for r in rows]), np.array([r["toxic"] for r in rows], float))
    return Model(restorer.value, log_odds(held[1] + held[3], held[0] + held[2], sizes[1] + sizes[3], sizes[0] + sizes[2]), final)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score``; each text by itself, whole, with no other column as input."""
    held = docs.sparkSession.sparkContext.broadcast((model.restorer, model.weights, model.final))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, weights, final = held.value
        of = word_scorer(weights)
        for part, found in _words_batches(batches, restorer):
            x = np.stack([stats(words, of) for words in found])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(x @ final, -30, 30))))], names=["doc_id", "score"])

    return docs.mapInArrow(run, "doc_id long, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_train: int = MAX_TRAIN) -> DataFrame:
    """Probability that a text is toxic: ``doc_id, score`` for every row of ``docs``.

    Noisy channel: words that hold obfuscating characters, letters spaced out or
    letters repeated three times or more become lattices of what they may stand
    for, and Viterbi decoding under a character trigram model of the whole corpus
    restores them, of any length, with the spaces between words where letters are
    spaced out or joined. The words of the text and the restored ones are scored by
    log-odds of their labelled holders, and a logistic step joins the evidence.
    ``labels`` should hold the rows to learn from only.

    Null and empty texts have no words and get the model's score for none. Texts of
    any length are read whole. Equal texts get equal scores; of rows that share a
    labelled id the smallest text is learnt from. Without labels every score is 0.5. An empty table
    gives no rows. Other columns are not read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("toxic"))
    return score(own, fit(own, known, max_train))
