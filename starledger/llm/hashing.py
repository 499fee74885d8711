"""Hashes of words in whole Arrow columns of text."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_ODD = 0x9E3779B97F4A7C15 | 1
#: Bytes that are split into words at once; longer texts are taken in parts that end between words.
PART = 1 << 20
#: Digests remembered per worker, of words of at most so many bytes: some 60 MB.
REMEMBERED, SHORT = 400_000, 48


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input moves every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=None)
def numbers(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers made from a seed."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(seed))


_KNOWN: dict[bytes, bytes] = {}


def _digests(words: list[bytes]) -> np.ndarray:
    """(words, 2) numbers: 128 bits of a cryptographic digest of each word."""
    out = list(map(_KNOWN.get, words))
    for i, d in enumerate(out):
        if d is None:
            word = words[i]
            out[i] = d = hashlib.blake2b(word, digest_size=16).digest()
            if len(word) <= SHORT and len(_KNOWN) < REMEMBERED:
                _KNOWN[word] = d
    return np.frombuffer(b"".join(out), np.uint64).reshape(-1, 2)


def _hash_words(words: list[bytes]) -> np.ndarray:
    """Both numbers of each word; equal words are digested once."""
    numbered = pa.array(words, pa.binary()).dictionary_encode()
    return _digests(numbered.dictionary.to_pylist())[numbered.indices.to_numpy(zero_copy_only=False)]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(two 64-bit numbers of every word of all texts in a row, number of words of each text).

    The two together are 128 bits of blake2b, so that unlike words, however long and however
    chosen, do not share both.
    """
    joined, counts = [], np.zeros(len(texts), np.int64)
    small = []  # neighbours that are hashed together

    def flush() -> None:
        if small:
            lists = [texts[i].split() for i in small]  # at the six white-space bytes of WORD
            counts[small] = list(map(len, lists))
            joined.append(_hash_words(list(chain.from_iterable(lists))))
            small.clear()

    size = 0
    for i, text in enumerate(texts):
        if len(text) > PART:
            flush()
            size = start = 0
            while start < len(text):
                cut = _SPACE.search(text, start + PART)
                end = cut.start() if cut else len(text)
                joined.append(_hash_words(text[start:end].split()))
                counts[i] += len(joined[-1])
                start = end
            continue
        small.append(i)
        size += len(text)
        if size > PART:
            flush()
            size = 0
    flush()
    return (np.concatenate(joined) if joined else np.empty((0, 2), np.uint64)), counts


#: Factors of the two halves of a block.
_LEFT, _RIGHT = 0xD1342543DE82EF95, 0x2545F4914F6CDD1D


def stretch_prints(words: np.ndarray, requests: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """64-bit prints of stretches of words; each request lists first places and ends.

    Blocks of 1, 2, 4, 8, ... words are hashed from their halves, every level mixed before the
    next, so that no arrangement of words cancels out. A stretch is the longest block at its
    start, the one at its end, and its length; the two overlap or meet.
    """
    out = [np.zeros(len(first), np.uint64) for first, _ in requests]
    lengths = [end - first for first, end in requests]
    block, level = words, 0
    while True:
        for (first, end), length, own in zip(requests, lengths, out):
            at = np.flatnonzero((length >= 1 << level) & (length < 2 << level))
            if len(at):
                ends = block[first[at]] * np.uint64(_LEFT) + block[end[at] - (1 << level)] * np.uint64(_RIGHT)
                own[at] = mix(mix(ends) + length[at].astype(np.uint64))
        if not any((length >= 2 << level).any() for length in lengths):
            return out
        half = 1 << level
        block = mix(block[:-half] * np.uint64(_LEFT) + block[half:] * np.uint64(_RIGHT) + np.uint64(level + 1))
        level += 1
