"""Byte-level BPE with reuse of content-defined chunks."""

from __future__ import annotations

import json
import re
from collections import OrderedDict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import byte_alphabet, released

# Fixed value: the split pattern of the library's byte-level pre-tokenizer.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A chunk ends before a space and a visible ASCII character with probability 2 ** -CUT_BITS, decided by the TAPS bytes around it.
CUT_BITS, TAPS = 7, 8
#: Chunks are at least so many bytes long; a text without spaces is one chunk.
LEAST_CHUNK = 128
#: Bytes of chunk encodings that a worker keeps; the least recently used go first.
CACHE_BYTES = 48 << 20


def cuts(data: bytes) -> list[int]:
    """Offsets at which a text is cut: a rolling hash over TAPS bytes picks among its spaces."""
    if len(data) < max(2 * LEAST_CHUNK, 2 * TAPS):
        return [0, len(data)]
    raw = np.frombuffer(data, np.uint8)
    spaces = np.flatnonzero((raw[:-1] == 32) & (raw[1:] > 32) & (raw[1:] < 127))
    spaces = spaces[(spaces >= LEAST_CHUNK) & (spaces <= len(data) - TAPS)]
    # The TAPS bytes from any offset on, as one number.
    windows = np.ndarray((len(data) - TAPS + 1,), "<u8", data, 0, (1,))
    found = spaces[(windows[spaces - TAPS // 2] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CUT_BITS) == 0]
    out = [0]
    for at in found.tolist():
        if at - out[-1] >= LEAST_CHUNK:
            out.append(at)
    return [*out, len(data)]


class ChunkEncoder:
    """Encodes and decodes whole texts as the library's byte-level BPE does.

    The vocabulary comes from the library's own file; its merges are ranked by
    id, so the plain BPE core that encodes a chunk gives the library's ids.

    Chunks are encoded alone, each once while it is cached, whatever document it
    is in. Where two meet, the stretch from the last sure pre-token start on the
    left to the first one on the right is encoded again, and further to the
    right until both agree on a pre-token start; from there on the right chunk's
    ids hold. A token of a space and a visible ASCII character is a sure start: a
    pre-token has a space at its front only, and no rule looks back.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # The leftmost special string, the longest of several at one place, parts a text in one pass.
        longest_first = sorted(self.special, key=len, reverse=True)
        self.parts = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split if self.special else None
        self.core = tiktoken.Encoding("chunks", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})
        size = max([*ranks.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in self.special.items())]:
            self.bytes_of[i] = token
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)
        self.is_sure = [len(b) > 1 and b[0] == 32 and 33 <= b[1] <= 126 for b in self.bytes_of]
        self.sure = np.array(self.is_sure)
        self.cache: OrderedDict[bytes, np.ndarray] = OrderedDict()
        self.cached, self.most, self.reused, self.encoded = 0, cache_bytes, 0, 0

    def _plain(self, data: bytes) -> np.ndarray:
        return np.array(self.core.encode_ordinary(data.decode()), np.uint32)

    def _chunk(self, data: bytes) -> np.ndarray:
        key = blake2b(data, digest_size=16).digest()
        ids = self.cache.get(key)
        if ids is not None:
            self.cache.move_to_end(key)
            self.reused += 1
            return ids
        ids = self.cache[key] = self._plain(data)
        self.encoded += 1
        self.cached += ids.nbytes + 200
        while self.cached > self.most:
            self.cached -= self.cache.popitem(last=False)[1].nbytes + 200
        return ids

    def _join(self, done: list[np.ndarray], data: bytes, at: int, right: np.ndarray, end: int) -> None:
        """Append ``right``, the ids of ``data[at:end]`` alone, to ``done``, the exact ids of ``data[:at]``."""
        left = done[-1]
        tail, first = left[-16:].tolist(), int(right[0])
        k = next((i for i in range(len(tail) - 1, -1, -1) if self.is_sure[tail[i]]), -1)
        if k >= 0 and self.is_sure[first]:
            # The usual case: the last word of the left and the first token of the right stand as they are.
            start = at - sum(len(self.bytes_of[i]) for i in tail[k:])
            if self.core.encode_ordinary(data[start : at + len(self.bytes_of[first])].decode("utf-8", "ignore")) == [*tail[k:], first]:
                done.append(right)
                return
        done.pop()
        while True:
            sure = np.flatnonzero(self.sure[left])
            if len(sure) or not done:
                break
            left = np.concatenate([done.pop(), left])
        k = int(sure[-1]) if len(sure) else 0
        start = at - int(self.length[left[k:]].sum())
        starts = np.cumsum(self.length[right]) - self.length[right] + at
        marks, tried = np.flatnonzero(self.sure[right]), 1
        while tried <= len(marks):
            j = int(marks[tried - 1])
            mark = int(starts[j])
            again = self._plain(data[start : mark + int(self.length[right[j]])])
            where = np.cumsum(self.length[again]) - self.length[again] + start
            m = int(np.searchsorted(where, mark))
            if m < len(again) and where[m] == mark and self.sure[again[m]]:
                done += [left[:k], again[:m], right[j:]]
                return
            tried *= 2
        done += [left[:k], self._plain(data[start:end])]

    def _segment(self, text: str) -> list[np.ndarray]:
        data = text.encode()
        edge = cuts(data)
        done = [self._chunk(data[: edge[1]])]
        for at, end in zip(edge[1:-1], edge[2:], strict=True):
            self._join(done, data, at, self._chunk(data[at:end]), end)
        return done

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; its special strings become their own ids, as in the library."""
        if not text:
            return np.empty(0, np.uint32)
        done: list[np.ndarray] = []
        for piece in self.parts(text) if self.parts else [text]:
            if piece in self.special:
                done.append(np.array([self.special[piece]], np.uint32))
            elif piece:
                done += self._segment(piece)
        return np.concatenate(done)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, special ones included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder, which keeps its chunk cache from task to task."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def _mapped(df: DataFrame, source: str, targets: dict[str, str], make) -> DataFrame:
    """All columns of ``df`` but ``source`` and ``targets`` (kinds by name), and those, a tuple that ``make`` makes from ``source``."""
    kept = [c for c in df.columns if c != source and c not in targets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = zip(*(make(cell.as_py()) for cell in part.column(source)), strict=True)
                arrays = [pa.array(column, pa.binary() if kind == "binary" else pa.string()) for column, kind in zip(made, targets.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *arrays], names=[*kept, *targets])

    types = dict(df.dtypes)
    return df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{source}`")).mapInArrow(released(run), ", ".join([*(f"`{c}` {types[c]}" for c in kept), *(f"`{c}` {kind}" for c, kind in targets.items())]))


def _to_ids(text: str | None, path: str) -> bytes:
    return encoder(path).encode(text).astype("<u4").tobytes()


def _to_text(ids: bytes | None, path: str) -> str:
    return encoder(path).decode(np.frombuffer(ids or b"", "<u4"))


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` (little-endian unsigned 32-bit ids, as binary) in place of ``text_col``.

    No shuffle: a worker reuses the chunks it has encoded, for all documents and
    tasks that reach it, in a cache of bounded size. An exchange of chunks over
    the whole cluster would move every text and every id at least once, which is
    dearer than encoding a shared chunk once per worker. Texts of any length are
    encoded whole, in time in proportion to it. Null counts as empty and gives no ids. Repeated rows get equal ids; an empty table gives no rows;
    a column that bears the name of ``ids_col`` is replaced.
    """
    return _mapped(docs, text_col, {ids_col: "binary"}, lambda text: (_to_ids(text, tokenizer_path),))


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with ``text_col`` in place of ``ids_col``; the reverse of :func:`encode`."""
    return _mapped(encoded, ids_col, {text_col: "string"}, lambda ids: (_to_text(ids, tokenizer_path),))


def round_trip(docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of :func:`encode`, and in place of its text what :func:`decode` makes of them.

    Both are made by one Python worker a task. One step after the other would be two
    workers a task, each with its own vocabulary and texts on their way.
    """

    def make(text: str | None) -> tuple[bytes, str]:
        ids = _to_ids(text, tokenizer_path)
        return ids, _to_text(ids, tokenizer_path)

    return _mapped(docs, text_col, {ids_col: "binary", text_col: "string"}, make)
