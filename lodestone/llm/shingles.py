"""Vectorised word and shingle hashes of UTF-8 texts (numpy, whole batches at once)."""

from __future__ import annotations

import numpy as np

#: A-Z to a-z, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes that stand between words: space and the controls 9 to 13.
IS_WORD = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
#: Texts are hashed in pieces of about so many bytes, cut between words.
PIECE = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _piece_hashes(piece: bytes) -> np.ndarray:
    data = np.frombuffer(piece, np.uint8)
    inside = IS_WORD[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), _BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    values = (data[inside].astype(np.uint64) + _U(1)) * powers[at]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * _STEP[2])


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a lower-cased text, in order; bounded memory for any length."""
    if len(text) <= PIECE:
        return _piece_hashes(text)
    found, at = [], 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and IS_WORD[text[end]]:
            end += 1
        found.append(_piece_hashes(text[at:end]))
        at = end
    return np.concatenate(found)


def shingle_set(text: str | bytes | None, size: int = 3) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of a text.

    A text of fewer words gives one shingle, the whole sequence; one without
    words, or null, gives none.
    """
    if text is None:
        return np.empty(0, np.uint64)
    data = text.encode() if isinstance(text, str) else text
    words = word_hashes(data.translate(LOWER))
    n = len(words)
    if not n:
        return words
    width = min(size, n)
    total = np.full(n - width + 1, _U(width * int(_BASE) % (1 << 64)))
    factor = 1
    for k in range(width):
        factor = factor * int(_STEP[0]) % (1 << 64)
        total += words[k : n - width + 1 + k] * _U(factor)
    return np.unique(mix(total))


def intersection_size(a: np.ndarray, b: np.ndarray) -> int:
    """Number of common values of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
