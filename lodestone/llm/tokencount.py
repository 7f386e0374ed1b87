"""Token counts by a two-tier lookup of pre-token lengths."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestone.llm.common import byte_alphabet

#: A worker's cache of pre-token lengths is emptied at so many entries, of LONGEST characters at most.
CACHE_ENTRIES = 400_000
LONGEST = 64
#: Pre-tokens of the corpus in the broadcast table, and in the summary that a task sends.
TABLE, SUMMARY = 65_536, 8_192

# Characters for which the library's normaliser (NFC, lower case) and classes are
# plain: below U+0180, without U+0130, whose lower case is two characters.
_LETTERS = "a-zªµºß-öø-įı-ſ"
_NUMBERS = "0-9²³¹¼-¾"
_BLANKS = r"\t-\r \x85\xa0"
_HARD = re.compile("[^\x00-įı-ſ]")
_BLANK = re.compile(r"[ \t-\r]+")
#: The pre-tokens of word_bpe_49k.json in lower-cased plain text.
_PRE_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+")


class Frequent:
    """The most frequent of a stream of pre-tokens, in bounded memory (lossy counting by batches).

    Whenever more than twice ``most`` are held, the rarer half goes; what went is
    undercounted if it comes again, by no more than the count at which it went.
    """

    def __init__(self, most: int):
        self.most, self.counts = most, Counter()

    def update(self, items) -> None:
        self.counts.update(items)
        if len(self.counts) > 2 * self.most:
            self.counts = Counter(dict(self.counts.most_common(self.most)))

    def top(self) -> list[tuple[str, int]]:
        return sorted((x for x in self.counts.items() if len(x[0]) <= LONGEST), key=lambda x: (-x[1], x[0]))[: self.most]


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's most frequent pre-tokens; the texts' plain parts count, whole."""
    seen = Frequent(SUMMARY)
    for batch in batches:
        for cell in batch.column(0):
            if cell.is_valid:
                seen.update(_PRE_TOKEN.findall(cell.as_py().lower()))
    top = seen.top()
    yield pa.RecordBatch.from_arrays([pa.array([[w for w, _ in top]]), pa.array([[n for _, n in top]], pa.list_(pa.int64()))], schema=_SUMMARY)


def _merge(frame):
    import pandas as pd

    seen = Counter()
    for words, counts in zip(frame["words"], frame["counts"], strict=True):
        for w, n in zip(words, counts, strict=True):
            seen[w] += n
        if len(seen) > 4 * TABLE:
            seen = Counter(dict(seen.most_common(2 * TABLE)))
    top = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:TABLE]
    return pd.DataFrame({"words": [[w for w, _ in top]], "counts": [[n for _, n in top]]})


_SUMMARY = pa.schema([("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def frequent_lengths(texts: DataFrame, path: str) -> tuple[bytes, bytes]:
    """Lengths of the corpus's most frequent pre-tokens, as newline-joined words and one byte each.

    Every text counts, whole. A task sends one summary of its SUMMARY most frequent
    pre-tokens; summaries, never pre-tokens, are merged by groups and then in the
    driver. The table holds TABLE of them at most, and its lengths are the library's.
    """
    tasks = texts.mapInArrow(_summarise, "words array<string>, counts array<bigint>").withColumn("part", F.spark_partition_id())
    merged = tasks.groupBy(F.pmod("part", F.lit(64)).alias("g")).applyInPandas(lambda frame: _merge(frame), "words array<string>, counts array<bigint>")
    seen: Counter[str] = Counter()
    for row in merged.toLocalIterator():
        for w, n in zip(row["words"], row["counts"], strict=True):
            seen[w] += n
    tok = Tokenizer.from_file(path)
    words = sorted(w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:TABLE])
    model, alphabet = tok.model, dict(enumerate(byte_alphabet()))
    lengths = [len(model.tokenize(w.encode().decode("latin-1").translate(alphabet))) for w in words]
    return "\n".join(words).encode(), bytes(lengths)


class _Lengths(dict):
    """Pre-token lengths; what is missing goes through the library's BPE model and is kept, in bounded memory."""

    def __init__(self, frequent: tuple[bytes, bytes], tokenizer: Tokenizer):
        words, lengths = frequent
        self.first = dict(zip(words.decode().split("\n"), lengths, strict=True)) if lengths else {}
        self.model, self.alphabet = tokenizer.model, dict(enumerate(byte_alphabet()))
        self.missed = 0
        super().__init__(self.first)

    def __missing__(self, word: str) -> int:
        self.missed += 1
        n = len(self.model.tokenize(word.encode().decode("latin-1").translate(self.alphabet)))
        if len(word) <= LONGEST:
            if len(self) >= CACHE_ENTRIES + len(self.first):
                self.clear()
                self.update(self.first)
            self[word] = n
        return n


class _Pieces(dict):
    """Tokens of pieces between blanks that hold other characters; the library counts each once while it is kept."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        super().__init__()

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= LONGEST:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = n
        return n


_lengths_of: dict[tuple[str, int], tuple[Tokenizer, _Lengths, _Pieces]] = {}


def counter(path: str, frequent: tuple[bytes, bytes]) -> Callable[[str | None], int]:
    """A function that counts the tokens of a whole text; its caches live as long as the worker."""
    key = path, hash(frequent)
    if key not in _lengths_of:
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        _lengths_of.clear()
        _lengths_of[key] = tok, _Lengths(frequent, tok), _Pieces(tok)
    tok, lengths, pieces = _lengths_of[key]
    look, find, special = lengths.__getitem__, _PRE_TOKEN.findall, [t.content for t in tok.get_added_tokens_decoder().values()]

    def count(text: str | None) -> int:
        if not text:
            return 0
        if any(s in text for s in special):
            return len(tok.encode(text, add_special_tokens=False).ids)
        if not _HARD.search(text):
            return sum(map(look, find(text.lower())))
        # No pre-token, and no step of the normaliser, reaches over a blank.
        parts = _BLANK.split(text)
        plain = " ".join([p for p in parts if not _HARD.search(p)])
        return sum(map(look, find(plain.lower()))) + sum([pieces[p] for p in parts if _HARD.search(p)])

    return count


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    Map-side only: a compact table of the corpus's most frequent pre-tokens
    (:func:`frequent_lengths`; bounded by TABLE) is broadcast; pre-tokens that it lacks
    are encoded by the library once per worker and cached there in bounded memory.
    Pieces between blanks that hold characters outside the plain range go through
    the library, cached likewise; texts with the tokenizer's special strings go
    through it whole. Written for the pre-tokenizer of word_bpe_49k.json. Texts of
    any length count whole. Null counts as empty: 0 bytes, 0 tokens. Repeated rows
    get equal counts; an empty table gives no rows; other columns are not read.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs.select(F.col(text_col).cast("string")), tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path, frequent.value)
        for batch in batches:
            n = pa.array([count(t.as_py()) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), n], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    counted = base.mapInArrow(run, f"doc_id {dict(base.dtypes)['doc_id']}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
