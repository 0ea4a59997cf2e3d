"""Hashes of runs of words and of slices of bytes, and anchors: positions that equal texts choose alike.

Runs of words may be told apart by their hashes (``Words``). A slice's hash (``Slices``) is the difference of two prefix sums; unlike
slices that mirror each other can share it, so it may choose places, but no result may rest on its equality. Anchors are window
minimisers: of every ``width`` consecutive grams the one with the least hash. The choice depends on the window's content only,
so two equal windows, wherever they stand, have the same anchor at the same place.
"""

from __future__ import annotations

import functools

import numpy as np
import xxhash

U = np.uint64
_PLACE = U((1 << 24) - 1)
PIECE_BYTES = 1 << 20  # texts are hashed in pieces of about this size, so a very long text needs no long arrays
_random = np.random.default_rng(7)
_TABLE = _random.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * U(2) + _random.integers(0, 2, (2, 256), dtype=np.uint64)
_JOIN = U(0x9FB21C651E98DF25), U(0xD6E8FEB86659FD93)
_BASE = [int(x) | 5 for x in _random.integers(1 << 62, 1 << 63, 2)]


@functools.cache
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (_BASE[which], pow(_BASE[which], -1, 1 << 64)):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    return made[0], made[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the entropy over all bits."""
    values = (values ^ (values >> U(33))) * U(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return values ^ (values >> U(33))


class Slices:
    """Hashes of slices of ``data``; ``which`` picks one of two independent functions."""

    def __init__(self, data: bytes, which: int = 0):
        bytes_ = np.frombuffer(data, dtype=np.uint8)
        powers, self.back = _powers(which, 1 << max(12, len(bytes_).bit_length()))
        self.sums = np.zeros(len(bytes_) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[which][bytes_] * powers[:len(bytes_)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stops] - self.sums[starts]) * self.back[starts])


def joined(left: np.ndarray, right: np.ndarray, which: int) -> np.ndarray:
    """Hashes of two neighbouring runs as one; neither a polynomial of them nor symmetric."""
    both = left * _JOIN[which] + right * _JOIN[1 - which]
    return both ^ (both >> U(32))


class Words:
    """Hashes of runs of consecutive words; ``which`` picks one of two independent functions.

    Each word has a 128-bit hash, half of it for each function. A run is joined from runs whose lengths are powers of two, so all
    runs of one length cost a few array operations, and only equal words in equal order give equal inputs to any step.
    """

    def __init__(self, words: list[bytes]):
        self.names = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), dtype="<u8").reshape(-1, 2)

    def runs(self, length: int, which: int = 0) -> np.ndarray:
        """The hash of every run of ``length`` words, by its first word; nothing if there are fewer words."""
        count = len(self.names) - length + 1
        if count < 1:
            return np.zeros(0, dtype=np.uint64)
        level, span = self.names[:, which], 1
        made, done = None, 0
        while True:
            if length & span:
                made = level if made is None else joined(made[:len(level) - done], level[done:], which)
                done += span
            if done == length:
                return made[:count]
            level = joined(level[:-span], level[span:], which)
            span *= 2


def word_pieces(words: list[bytes], overlap: int, size: int = PIECE_BYTES):
    """``(first word, words)`` of consecutive pieces of about ``size`` bytes; each repeats ``overlap`` words of the next.

    Windows of ``overlap + 1`` words thus start in exactly one piece each.
    """
    if sum(map(len, words)) + len(words) <= size:
        yield 0, words
        return
    ends = np.cumsum([len(word) + 1 for word in words])
    first = 0
    while first < len(words):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + size)))
        yield first, words[first:last + overlap]
        first = last


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` grams the place of its least gram, the leftmost of equal ones."""
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return (least & _PLACE).astype(np.int64)


def known(values: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Which ``values`` are among the sorted ``members``."""
    if not len(members):
        return np.zeros(len(values), dtype=bool)
    return members[np.minimum(np.searchsorted(members, values), len(members) - 1)] == values


def tallied(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each stands there."""
    return np.unique(values, return_counts=True)
