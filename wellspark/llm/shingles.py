"""Word shingles as 64-bit hashes, in numpy, for use inside tasks."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xD6E8FEB86659FD93)
_WORDS: dict[str, int] = {}
_WORDS_KEPT = 500_000  # the memo of word hashes is emptied beyond this


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def word_hashes(tokens: list[str]) -> np.ndarray:
    if len(_WORDS) > _WORDS_KEPT:
        _WORDS.clear()
    memo = _WORDS
    for w in set(tokens).difference(memo):
        memo[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(memo.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def shingle_hashes(h: np.ndarray, size: int = 5) -> np.ndarray:
    """Hash of every run of ``size`` words; a shorter text is one shingle; no words, none."""
    if not len(h):
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out = out * _MUL + h[k:k + n]
    return mix(out)


def multiset(text: str | None, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, their counts)."""
    return np.unique(shingle_hashes(word_hashes(words(text)), size), return_counts=True)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Multiset overlap: the sum of the smaller counts over the sum of the larger ones."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    union = int(a[1].sum() + b[1].sum()) - common
    return common / union if union else 0.0
