"""Elias-Fano code of sorted whole numbers, and a trie of such sequences.

A sequence of n numbers below u takes about 2 + log2(u / n) bits each: the low bits of every
number side by side, the high bits as a bit vector with a one for each number and a zero after
each value of the high bits. Sequences are read in place from a buffer, for many places or
values at once; opening one makes a directory of its high bits.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

U = np.uint64
_ONE = U(1)


def _or_at(words: np.ndarray, places: np.ndarray, values: np.ndarray) -> None:
    """Sets the values' bits in the words at sorted places."""
    if len(places):
        first = np.flatnonzero(np.diff(places, prepend=-1))
        words[places[first]] |= np.bitwise_or.reduceat(values, first)


class Monotone:
    """Sorted numbers below 2^63 in a buffer made by ``encode``."""

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values, n = values.astype(U), len(values)
        bits = max(0, ((int(values[-1]) + 1) // n).bit_length() - 1) if n else 0
        high = (values >> U(bits)).astype(np.int64)
        places = np.arange(n) * bits
        lows = np.zeros((n * bits >> 6) + 2, U)
        low, shift = values & U((1 << bits) - 1), (places & 63).astype(U)
        _or_at(lows, places >> 6, low << shift)
        # what a word has no room for; a shift by 64 is made in two steps
        _or_at(lows, (places >> 6) + 1, low >> _ONE >> (U(63) - shift))
        ones = high + np.arange(n)
        highs = np.zeros((n + (int(high[-1]) if n else 0) >> 6) + 1, U)
        _or_at(highs, ones >> 6, _ONE << (ones & 63).astype(U))
        return np.array([n, bits, len(lows)], U).tobytes() + lows.tobytes() + highs.tobytes()

    def __init__(self, data: bytes) -> None:
        words = np.frombuffer(data, U)
        self.n, self.bits, n_lows = (int(x) for x in words[:3])
        self.lows = words[3 : 3 + n_lows]
        ones = np.flatnonzero(np.unpackbits(words[3 + n_lows :].view(np.uint8), bitorder="little"))
        self.high = ones - np.arange(self.n)
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(self.high))])  # of each value of the high bits

    def _low(self, i: np.ndarray) -> np.ndarray:
        place = i * self.bits
        word, shift = place >> 6, (place & 63).astype(U)
        both = (self.lows[word] >> shift) | (self.lows[word + 1] << _ONE << (U(63) - shift))
        return (both & U((1 << self.bits) - 1)).astype(np.int64)

    def value(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places i, each below n."""
        return self.high[i] << self.bits | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Places of the first numbers of at least x; n where there is none."""
        out = np.full(len(x), self.n, np.int64)
        some = np.flatnonzero((x >> self.bits) < len(self.begin) - 1)
        high, low = x[some] >> self.bits, x[some] & ((1 << self.bits) - 1)
        start, end = self.begin[high], self.begin[high + 1]
        left = np.flatnonzero(start < end)
        while len(left):
            middle = (start[left] + end[left]) >> 1
            less = self._low(middle) < low[left]
            start[left[less]] = middle[less] + 1
            end[left[~less]] = middle[~less]
            left = left[start[left] < end[left]]
        out[some] = start
        return out


class Level(NamedTuple):
    """Children of the level above: ``pointers[i]`` is where those of node i begin, and
    ``names`` are the children's, each group's added to the last sum of the group before, so
    that all are one sorted sequence."""

    pointers: Monotone
    names: Monotone

    @staticmethod
    def encode(sizes: np.ndarray, names: np.ndarray) -> tuple[bytes, bytes]:
        """``sizes``: children of each node; ``names`` ascend in a group."""
        some = sizes[sizes > 0]
        last = names[np.cumsum(some) - 1] + 1
        base = np.repeat(np.cumsum(last) - last, some)
        return Monotone.encode(np.concatenate([[0], np.cumsum(sizes)])), Monotone.encode(base + names + 1)

    def find(self, node: np.ndarray, name: np.ndarray) -> np.ndarray:
        """Places of the nodes' children of these names, -1 where there is none (or no node).
        Equal nodes next to each other are opened once."""
        out = np.full(len(node), -1, np.int64)
        known = np.flatnonzero(node >= 0)
        if not len(known) or not self.names.n:
            return out
        node = node[known]
        first = np.flatnonzero(np.diff(node, prepend=-1))
        times = np.diff(first, append=len(node))
        begin, end = self.pointers.value(node[first]), self.pointers.value(node[first] + 1)
        base = np.where(begin > 0, self.names.value(np.maximum(begin - 1, 0)), 0)
        wanted = np.repeat(base, times) + name[known] + 1
        at = self.names.successor(wanted)
        hit = np.flatnonzero(at < np.repeat(end, times))
        hit = hit[self.names.value(at[hit]) == wanted[hit]]
        out[known[hit]] = at[hit]
        return out
