"""Word shingles as 64-bit hashes, for whole texts at a time with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_CACHE_WORDS = 300_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Hashes()
_MULTIPLY, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_POWER = 0xD1342543DE82EF95
_INVERSE = pow(_POWER, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def word_hashes(text: bytes | None) -> np.ndarray:
    """One hash per word; A-Z are lower-cased, white space is space and \\t to \\r."""
    words = (text or b"").lower().split()
    if len(_words) > _CACHE_WORDS:
        _words.clear()
    return np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))


def forget() -> None:
    """Lets the words go that this worker has met."""
    _words.clear()


def positions(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The hash of the shingle at each word; a shorter text is one shingle as a whole."""
    n = len(words)
    width = min(width, n)
    h = np.full(max(n - width + 1, 0) if n else 0, width, dtype=np.uint64)
    for k in range(width):
        h = h * _MULTIPLY + words[k : n - width + 1 + k]
    return mix(h)


def of_texts(data: np.ndarray, ends: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of many texts at once, and how many each text has; those of fewer words than `width` have none.

    The texts' bytes stand one after another in `data`, each up to its end. Words are told apart as in `word_hashes`, by other hashes.
    """
    starts = np.append(0, ends[:-1])
    letter = _LETTER[data]
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    for edge, at in ((first, starts[starts < ends]), (last, ends[starts < ends] - 1)):
        edge[at] = letter[at]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    # a word's hash is its part of the running sum of letters times powers, moved to the text's start
    powers, inverses = (np.multiply.accumulate(np.full(len(data), v, dtype=np.uint64)) for v in (_POWER, _INVERSE))
    sums = np.append(np.uint64(0), np.cumsum((_LOWER[data] + np.uint64(1)) * powers, dtype=np.uint64))
    words = mix((sums[end] - sums[begin]) * inverses[begin])
    n_words = np.diff(np.searchsorted(begin, ends), prepend=0)
    n = max(len(words) - width + 1, 0)
    h = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        h = h * _MULTIPLY + words[k : k + n]
    text = np.repeat(np.arange(len(ends)), n_words)
    return mix(h[text[:n] == text[len(text) - n :]]), np.maximum(n_words - width + 1, 0)


def shingle_set(text: bytes | None) -> np.ndarray:
    return np.unique(positions(word_hashes(text)))
