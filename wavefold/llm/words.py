"""Words as numbers, for the operators that work on word sequences in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_GOLDEN, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Vocabulary(dict):
    """Word (bytes) -> dense number, by first sight. ``words`` has them in order."""

    def __init__(self):
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self.words)
        self.words.append(word)
        return at

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashes(self, seed: int = 0) -> np.ndarray:
        """XXH64 of every word, unsigned."""
        digest = xxhash.xxh64_intdigest
        return np.fromiter((digest(w, seed) for w in self.words), np.uint64, len(self.words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which near numbers part (wraps on purpose)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def chained(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Hash of a sequence that goes on with ``then`` after one hashed to ``first``."""
    return mix(first * _GOLDEN + then)


#: ASCII white space, and how much of eight bytes belongs to a word of so many.
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_PART = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Words of more bytes than this are hashed one by one.
LONG_WORD = 64


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (anything but ASCII white space) of the texts in order, and how many words each text has."""
    raw = b"\n".join(texts) + bytes(8)
    laid = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(laid) - 6, np.int8)  # one more place before the first byte and one after the last
    np.logical_not(_SPACE[laid[:-8]], out=inside[1:-1].view(bool))
    turns = np.diff(inside)
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    sizes = ends - starts
    eights = np.ndarray(len(laid) - 7, "<u8", raw, strides=(1,))  # the eight bytes from each place on
    h = mix(sizes.astype(np.uint64) * _GOLDEN + (eights[starts] & _PART[np.minimum(sizes, 8)]))
    more, at = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD)), 8
    while len(more):
        h[more] = chained(h[more], eights[starts[more] + at] & _PART[np.minimum(sizes[more] - at, 8)])
        at += 8
        more = more[sizes[more] > at]
    for k in np.flatnonzero(sizes > LONG_WORD):
        h[k] = xxhash.xxh64_intdigest(raw[starts[k]:ends[k]])
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    edges = np.concatenate(([0], np.cumsum(lengths + 1)))
    return h, np.diff(np.searchsorted(starts, edges))
