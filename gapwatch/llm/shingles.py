"""Words and word shingles of a text as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

_POWERS = np.ones(1, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value scattered over all 64 bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        powers = np.full(max(n, 64, 2 * len(_POWERS)), _BASE, dtype=np.uint64)
        powers[0] = 1
        _POWERS = np.multiply.accumulate(powers)
    return _POWERS


def lowered(text: str) -> np.ndarray:
    """The UTF-8 bytes of the text, A-Z lower-cased."""
    return _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and length of each word; words are cut at the six white space characters."""
    space = _IS_SPACE[raw]
    inside = ~space
    if not inside.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(inside & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(inside & np.concatenate((space[1:], [True]))) + 1
    lengths = ends - starts
    places = np.flatnonzero(inside)
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    within = np.arange(len(places)) - np.repeat(firsts, lengths)
    terms = (raw[places].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[within]
    hashes = mixed(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, starts, lengths


def word_hashes(text: str) -> np.ndarray:
    """One hash per word of the text, A-Z lower-cased."""
    return word_spans(lowered(text))[0]


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of the whole sequence if there are fewer."""
    if not len(words):
        return words
    n = min(size, len(words))
    total = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        total = mixed(total + np.uint64(0x632BE59BD9B4E019)) + words[i: len(words) - n + 1 + i]
    return np.unique(mixed(total))
