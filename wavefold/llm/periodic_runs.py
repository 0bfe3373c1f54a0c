"""Runs of repeating words, found by block convolution (operator 12).

Words are runs of anything but ASCII white space. A run is a stretch of
consecutive words whose smallest period is q (words q apart are equal), at least
``max(MIN_LENGTH, MIN_POWER * q)`` words long, that no neighbouring word extends.

Method, for dyadic block lengths B = 8, 16, 32, ...:

1. The text is cut into aligned blocks of B words. Scale B answers for the periods
   in [B, 2B), scale 8 for those below 8 as well. A run of such a period is long
   enough to hold a whole aligned block together with that block's copy one period
   on, so every run is seeded by a block that occurs again at distance q.
2. A block can only occur again below 2B if each of its words does, so blocks with a
   word whose next occurrence is farther off are passed over (nothing is lost).
3. For the other blocks the squared differences to every place of the following
   window are summed by an exact number-theoretic transform modulo a prime: the
   distances with sum zero are the block's occurrences. (A multiple of the prime
   would be a false one; step 5 would see it.)
4. A block inside a known run of a period of at most B needs no distances d whose
   copy ends in that run: by Fine and Wilf's theorem such a d is no smallest period.
   So a text that is one word over and over stays linear at every scale.
5. Distances seed extensions: the stretch in which words d apart are equal, by
   binary search over prefix hashes, then compared word by word. It stays if it is
   long enough and no divisor of d is a period of it.

Each document is worked on in the task that reads it; nothing is shuffled. A task
holds a slice of a batch (about 4 MB of texts, or one longer text).

Defined cases: null and empty texts have no words and no runs; repeated rows give
repeated results; null ids stay null; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import lru_cache
from hashlib import sha256
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wavefold.llm.common import drop_worker_state, id_text, rows_of
from wavefold.llm.words import Vocabulary

MIN_LENGTH, MIN_POWER = 24, 3
#: Block length of the first scale; MIN_LENGTH holds two of them and a period below.
FIRST_BLOCK = 8
#: Numbers transformed at once, and the longest part of a block that one transform looks for (of a longer block
#: the first words are looked for, window by window; extension decides on the rest).
CELLS, LONGEST_HEAD = 1 << 19, 1 << 16

#: A prime with a root of unity for every power of two up to 2 ** 23, and its generator.
PRIME, GENERATOR = 998_244_353, 3
_P = np.uint64(PRIME)
#: Moduli and bases of the prefix hashes.
_HASHES = ((2_147_483_647, 1_000_003), (2_147_483_629, 69_069))

Run = tuple[int, int, int]


@lru_cache(64)
def _roots(half: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    out = np.ones(half, np.uint64)
    step, power = 1, root
    while step < half:
        out[step:2 * step] = out[:step] * np.uint64(power) % _P
        step, power = 2 * step, power * power % PRIME
    return out


def _forward(a: np.ndarray) -> np.ndarray:
    """Transform of every row, in bit-reversed order; the length is a power of two."""
    rows, size = a.shape
    half = size // 2
    while half:
        parts = a.reshape(rows, -1, 2 * half)
        low, high = parts[..., :half], parts[..., half:]
        diff = (low + (_P - high)) * _roots(half, False) % _P
        low += high
        low %= _P
        parts[..., half:] = diff
        half //= 2
    return a


def _backward(a: np.ndarray) -> np.ndarray:
    rows, size = a.shape
    half = 1
    while half < size:
        parts = a.reshape(rows, -1, 2 * half)
        high = parts[..., half:] * _roots(half, True) % _P
        low = parts[..., :half].copy()
        parts[..., :half] = (low + high) % _P
        parts[..., half:] = (low + (_P - high)) % _P
        half *= 2
    return a * np.uint64(pow(size, PRIME - 2, PRIME)) % _P


def occurrences(heads: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """At which of the first 2 * b places of its window every row's head occurs, as booleans.

    ``heads`` are rows of b numbers below the prime (b a power of two), ``windows`` rows of 3 * b.
    """
    rows, b = heads.shape
    x, y = heads.astype(np.uint64), windows.astype(np.uint64)
    there = np.zeros((rows, 4 * b), np.uint64)
    there[:, :3 * b] = y
    here = np.zeros_like(there)
    here[:, :b] = x[:, ::-1]
    product = _backward(_forward(there) * _forward(here) % _P)[:, b - 1:3 * b - 1]
    squares = np.zeros((rows, 3 * b + 1), np.uint64)
    np.cumsum(y * y % _P, axis=1, out=squares[:, 1:])
    window = squares[:, b:3 * b] - squares[:, :2 * b]
    own = (x * x % _P).sum(axis=1, keepdims=True)
    return (own + window) % _P == 2 * product % _P


class _Prefixes:
    """Prefix hashes of a number sequence: how far equal stretches go, by binary search."""

    def __init__(self, x: np.ndarray):
        self.parts = []
        for modulus, base in _HASHES:
            powers = np.ones(len(x) + 1, np.int64)
            step, power = 1, base
            while step < len(powers):
                powers[step:2 * step] = powers[:min(step, len(powers) - step)] * power % modulus
                step, power = 2 * step, power * power % modulus
            sums = np.zeros(len(x) + 1, np.int64)
            np.cumsum((x + 1) % modulus * powers[:-1] % modulus, out=sums[1:])
            self.parts.append((modulus, powers, sums))

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of that length from a and from b > a look equal."""
        out = np.ones(len(a), bool)
        for modulus, powers, sums in self.parts:
            left = (sums[a + length] - sums[a]) % modulus * powers[b - a] % modulus
            out &= left == (sums[b + length] - sums[b]) % modulus
        return out

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """Length of the longest equal stretches from (or, ``back``, up to) a and b, at most ``most``."""
        got = np.zeros_like(a)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            try_ = got + step
            can = np.flatnonzero(try_ <= most)
            shift = try_[can] if back else 0
            good = can[self.equal(a[can] - shift, b[can] - shift, try_[can])]
            got[good] += step
            step //= 2
        return got


def _prime_factors(n: int) -> Iterator[int]:
    p = 2
    while p * p <= n:
        if n % p == 0:
            yield p
            while n % p == 0:
                n //= p
        p += 1
    if n > 1:
        yield n


def _stretch(x: np.ndarray, at: int, d: int, first: int, end: int) -> tuple[int, int]:
    """The stretch around ``at`` in which numbers d apart are equal, word by word."""
    left = at
    while left > first and x[left - 1] == x[left - 1 + d]:
        left -= 1
    right = at
    while right + d < end and x[right] == x[right + d]:
        right += 1
    return left, right + d


def _holds(x: np.ndarray, start: int, end: int, d: int) -> bool:
    return np.array_equal(x[start:end - d], x[start + d:end])


def _gaps(x: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Distance to the same number's next place in the same document (very far if there is none)."""
    gap = np.full(len(x), np.iinfo(np.int64).max // 2)
    key = doc * (int(x.max(initial=0)) + 1) + x
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gap


def runs_of(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[int, list[Run]]:
    """Runs of the documents laid end to end in ``x``, by the document's place in ``starts``.

    A run is (first word of the document's own count, length, period); lists are in order of start, then period.
    """
    found: dict[int, list[Run]] = {}
    if not len(x):
        return found
    gap = _gaps(x, np.repeat(np.arange(len(starts)), ends - starts))
    other = int(x.max()) + 1
    padded = None
    hashes: _Prefixes | None = None
    known_end = np.zeros(len(x), np.int64)
    block = FIRST_BLOCK
    while True:
        least = 1 if block == FIRST_BLOCK else block
        live = np.flatnonzero(ends - starts >= max(MIN_LENGTH, MIN_POWER * least))
        if not len(live):
            return found
        # whole blocks of the documents that are long enough for a period of this scale
        count = (ends[live] - starts[live]) // block
        doc = np.repeat(live, count)
        at = starts[doc] + block * (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count))
        edges = np.empty(2 * len(at), np.int64)
        edges[::2], edges[1::2] = at, at + block
        highest = np.maximum.reduceat(np.append(gap, 0), edges)[::2]
        lowest = np.maximum(least, known_end[at] - at - block + 1)
        alive = (highest < 2 * block) & (lowest < 2 * block) & (at + block + lowest <= ends[doc])
        doc, at, lowest = doc[alive], at[alive], lowest[alive]
        if len(at) and padded is None:
            padded = np.append(x, other)
        seeds: list[tuple[np.ndarray, ...]] = []
        head = min(block, LONGEST_HEAD)
        rows = max(1, CELLS // (4 * head))
        for k, skip in product(range(0, len(at), rows), range(0, 2 * block, 2 * head)):
            far = lowest[k:k + rows] < skip + 2 * head
            own, place, first = doc[k:k + rows][far], at[k:k + rows][far], lowest[k:k + rows][far]
            if not len(own):
                continue
            index = place[:, None] + np.arange(skip, skip + 3 * head)
            index = np.where(index < ends[own][:, None], index, len(x))
            row, d = np.nonzero(occurrences(x[place[:, None] + np.arange(head)], padded[index]))
            d += skip
            good = d >= first[row]
            seeds.append((own[row[good]], place[row[good]], d[good]))
        if seeds:
            own, place, d = (np.concatenate(part) for part in zip(*seeds))
            if len(own):
                hashes = hashes or _Prefixes(x)
                for document, start, end, period in _extended(x, hashes, own, place, d, starts, ends):
                    found.setdefault(document, []).append((start - int(starts[document]), end - start, period))
                    np.maximum(known_end[start:end], end, out=known_end[start:end])
        block *= 2


def _extended(x, hashes, own, place, d, starts, ends) -> Iterator[tuple[int, int, int, int]]:
    """(document, start, end, period) of the runs that the seeds belong to."""
    right = hashes.reach(place, place + d, ends[own] - place - d)
    left = hashes.reach(place, place + d, place - starts[own], back=True)
    begin, end = place - left, place + right + d
    long_enough = (end - begin >= np.maximum(MIN_LENGTH, MIN_POWER * d))
    columns = [c[long_enough] for c in (own, begin, end, d, place)]
    order = np.lexsort(columns[::-1])
    sorted_ = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_[:4]])
    seen = set()
    for document, a, b, period, at in np.stack(sorted_, axis=1)[new].tolist():
        if (document, a, b, period) in seen:
            continue
        seen.add((document, a, b, period))
        if not _holds(x, a, b, period):  # two stretches of one hash
            a, b = _stretch(x, at, period, int(starts[document]), int(ends[document]))
            if b - a < max(MIN_LENGTH, MIN_POWER * period) or (document, a, b, period) in seen:
                continue
            seen.add((document, a, b, period))
        if not any(_holds(x, a, b, period // p) for p in _prime_factors(period)):
            yield document, a, b, period


def dropped(runs: list[Run], n: int) -> np.ndarray:
    """Which of n words stand in a run after its first period."""
    out = np.zeros(n, bool)
    for start, length, period in runs:
        out[start + period:start + length] = True
    return out


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rearranged: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """Per document row: doc_id, n_words, runs (array of start, length, period, in order) and collapsed.

    ``collapsed`` has the words that no run repeats, joined by one space (null if the text has no run, so that
    whole texts do not travel twice; ``collapsed_sha256`` is never null). ``rearranged(doc_id, n)`` may say which of the
    n words stands at each place, for texts that are to be read in another order than they are written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for ids, texts in rows_of(batches, "doc_id", "text"):
            vocabulary = Vocabulary()
            laid, split = [], []
            for doc_id, text in zip(ids, texts):
                words = text.encode().split()
                x = vocabulary.numbers(words)
                order = rearranged(doc_id, len(words)) if rearranged and words else None
                if order is not None:
                    x = x[order]
                    words = [words[i] for i in order.tolist()]
                laid.append(x)
                split.append(words)
            ends = np.cumsum([len(x) for x in laid])
            starts = ends - [len(x) for x in laid]
            found = runs_of(np.concatenate(laid), starts, ends) if laid else {}
            lists, digests, collapsed = [], [], []
            for k, words in enumerate(split):
                own = sorted(found.get(k, ()), key=lambda r: (r[0], r[2]))
                if own:
                    gone = dropped(own, len(words)).tolist()
                    words = [w for w, out in zip(words, gone) if not out]
                joined = b" ".join(words)
                lists.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                digests.append(sha256(joined).hexdigest())
                collapsed.append(joined.decode() if own else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(ends - starts, pa.int64()),
                "runs": pa.array(lists, pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))),
                "collapsed": pa.array(collapsed, pa.string()), "collapsed_sha256": pa.array(digests, pa.string())})

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string, "
             "collapsed_sha256 string")


def strongest(own: list[Run]) -> Run | None:
    """The run of the greatest exact length / period; ties: the smallest start, then period."""
    return max(own, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
