"""Words of many texts at once, as 64-bit hashes in numpy.

Words are runs of bytes other than blank, tab, line end, vertical tab, form
feed and carriage return, with A-Z in lower case.  In UTF-8 these bytes occur
in no other character, so bytes cut texts as characters would.
"""

from __future__ import annotations

import hashlib

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PRIME, _START = np.uint64(0x100000001B3), np.uint64(0xCBF29CE484222325)
#: Longer words are hashed one by one.
LONG_BYTES = 64


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets of each text's words), in order."""
    parts = [(t or "").encode() for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    data = _LOWER[np.frombuffer(b" ".join(parts) + b" ", np.uint8)]
    word = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=0, append=0))
    begin, end = edge[::2], edge[1::2]
    offsets = np.searchsorted(begin, np.concatenate([[0], np.cumsum(sizes)]))
    length = np.minimum(end - begin, LONG_BYTES + 1)
    order = np.argsort(-length.astype(np.int16), kind="stable")
    at, count = begin[order], np.bincount(length, minlength=LONG_BYTES + 2)[::-1].cumsum()[::-1]
    h = np.full(len(begin), _START)
    for j in range(LONG_BYTES):  # words longer than j come first
        k = count[j + 1]
        if not k:
            break
        h[:k] = (h[:k] ^ data[at[:k] + j]) * _PRIME
    out = np.empty_like(h)
    out[order] = h
    for i in order[:count[LONG_BYTES + 1]]:
        out[i] = int.from_bytes(hashlib.blake2b(data[begin[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(out), offsets


def shingle_sets(texts: list[str | None], words: int = 5) -> list[np.ndarray]:
    """Each text's set of shingles, as ascending 64-bit hashes: every ``words``
    consecutive words; of fewer words the whole sequence; of none nothing."""
    h, offsets = word_hashes(texts)
    shingle = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for k in range(words):
        shingle = mix(shingle * np.uint64(0x9E3779B97F4A7C15) + h[k:k + len(shingle)])
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= words:
            out.append(np.unique(shingle[a:b - words + 1]))
        elif b > a:
            few = np.array([b - a], np.uint64)
            for k in range(a, b):
                few = mix(few * np.uint64(0x9E3779B97F4A7C15) + h[k:k + 1])
            out.append(few)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
