"""A compact FM-index over word codes: wavelet-tree ranks, backward search, sampled suffix positions.

The text is a row of runs of codes 1, 2, ... with a separator (code 0) after each run.
Separators count as different from one another, so a suffix is ordered by what stands
before its separator, and no match crosses one.  Once built, the index holds the
wavelet levels of the Burrows-Wheeler transform, packed to bits with running counts,
and the sampled positions; neither text nor suffix array is kept.

All searches are vectorised: each step moves every query at once.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each i."""
        word = i >> 6
        low = (_ONE << (i & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & _ONE


class Wavelet:
    """A wavelet tree, kept level by level: rank of a code and code at a place."""

    def __init__(self, codes: np.ndarray, sigma: int):
        self.depth = max(1, int(sigma - 1).bit_length())
        self.levels, self.zeros = [], []
        row = codes
        for level in range(self.depth - 1, -1, -1):
            bit = ((row >> level) & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(row) - bit.sum()))
            row = np.concatenate((row[~bit], row[bit]))
        self.base = self._down(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _down(self, code: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            ones = bits.rank(i)
            i = np.where((code >> (self.depth - 1 - k)) & 1, zeros + ones, i - ones)
        return i

    def rank(self, code: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each code stands before its i."""
        return self._down(code, i) - self.base[code]

    def access(self, i: np.ndarray) -> np.ndarray:
        """The code at each i."""
        code = np.zeros(len(i), dtype=np.int64)
        for bits, zeros in zip(self.levels, self.zeros, strict=True):
            bit = bits.get(i).astype(bool)
            ones = bits.rank(i)
            code = code * 2 + bit
            i = np.where(bit, zeros + ones, i - ones)
        return code


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the compared length over the suffixes that still tie."""
    n = len(text)
    seps = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + (len(seps) - 1)
    rank[seps] = np.arange(len(seps))
    order = np.argsort(rank, kind="stable")
    tied = order

    def ranks(where: np.ndarray, first: np.ndarray, second: np.ndarray, base: np.ndarray) -> np.ndarray:
        new = np.ones(len(where), dtype=bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        begin = np.maximum.accumulate(np.where(new, base, 0))
        return begin

    place = np.arange(n)
    begin = ranks(order, rank[order], np.zeros(n, dtype=np.int64), place)
    rank[order] = begin
    step = 1
    while True:
        counts = np.bincount(rank[tied], minlength=n)
        tied = tied[counts[rank[tied]] > 1]
        if not len(tied):
            return order
        # a suffix that still ties is longer than ``step``, so its end lies within the text
        first, second = rank[tied], rank[np.minimum(tied + step, n - 1)]
        by = np.lexsort((second, first))
        tied, first, second = tied[by], first[by], second[by]
        edge = np.ones(len(tied), dtype=bool)
        edge[1:] = first[1:] != first[:-1]
        group = np.maximum.accumulate(np.where(edge, np.arange(len(tied)), 0))
        base = first + np.arange(len(tied)) - group
        order[base] = tied
        rank[tied] = ranks(tied, first, second, base)
        step *= 2


class FMIndex:
    """Index of ``text`` (codes from 1, a 0 after each run) with codes below ``sigma``."""

    def __init__(self, text: np.ndarray, sigma: int, every: int = 16, order: np.ndarray | None = None):
        order = suffix_order(text) if order is None else order
        self.n = len(text)
        before = text[order - 1]
        self.wavelet = Wavelet(before, sigma)
        #: Of the separators, only the number matters: none is ever looked up.
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))[:sigma]
        sampled = (order % every == 0) | (before == 0)
        self.marked = Bits(sampled)
        self.sample = order[sampled]

    def extend(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: put ``code`` before what each interval matches."""
        both = self.wavelet._down(np.concatenate((code, code)), np.concatenate((lo, hi)))
        shift = self.first[code] - self.wavelet.base[code]
        return both[:len(lo)] + shift, both[len(lo):] + shift

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of phrases, given as rows of codes filled up with zeros."""
        lo = np.zeros(len(phrases), dtype=np.int64)
        hi = np.full(len(phrases), self.n, dtype=np.int64)
        live = np.flatnonzero(lengths > 0)
        for step in range(1, int(lengths.max(initial=0)) + 1):
            live = live[(lengths[live] >= step) & (lo[live] < hi[live])]
            if not len(live):
                break
            code = phrases[live, lengths[live] - step]
            lo[live], hi[live] = self.extend(code, lo[live], hi[live])
        return lo, hi

    def locate(self, rank: np.ndarray) -> np.ndarray:
        """Text position of each suffix rank: walk back to a sampled one."""
        at, steps = rank.copy(), np.zeros(len(rank), dtype=np.int64)
        live = np.arange(len(rank))
        while len(live):
            live = live[self.marked.get(at[live]) == 0]
            if not len(live):
                break
            code = self.wavelet.access(at[live])
            at[live] = self.first[code] + self.wavelet.rank(code, at[live])
            steps[live] += 1
        return self.sample[self.marked.rank(at)] + steps
