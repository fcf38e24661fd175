"""Bin completion over a histogram of lengths.

There are at most ``capacity`` different lengths however many documents there are, so
the plan is made for counts of lengths: a pattern is one filling of a bin and how many
bins get it.  The search takes the largest length left, lists undominated fillings
of the room beside it, applies one as often as the counts allow and goes on; a branch
is left when its waste shows that it cannot beat the incumbent.  The first incumbent is
best-fit decreasing; the search ends when no packing can have fewer bins (``fewest``), when all is tried,
or after a number of patterns that grows with the number of lengths, enough for whole solutions.
Work depends on ``capacity`` only, not on the number of documents.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np

#: Steps of the walk over the fillings around one largest document, and fillings kept of it.
FILL_NODES, FILL_KEEP = 300, 4
#: Patterns tried in all: some, and for each length as many as a whole solution may need.
SEARCH_NODES, NODES_A_LENGTH = 2500, 6

Pattern = tuple[int, tuple[int, ...]]


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing, for runs of equal lengths and of equal bins at once."""
    open_bins: dict[int, list[list]] = {}
    for length in range(capacity, 0, -1):
        n = int(counts[length])
        while n:
            room = next((r for r in range(length, capacity) if open_bins.get(r)), None)
            if room is None:
                per = 1
                open_bins.setdefault(capacity - length, []).append([n, (length,)])
                n -= n * per
                if capacity - length >= length:  # the rest of these may share bins
                    group = open_bins[capacity - length].pop()
                    per = capacity // length
                    full, left = divmod(group[0], per)
                    if full:
                        open_bins.setdefault(capacity - per * length, []).append([full, (length,) * per])
                    if left:
                        open_bins.setdefault(capacity - left * length, []).append([1, (length,) * left])
                continue
            group = open_bins[room][-1]
            fits = room // length
            full = min(group[0], n // fits)
            if full:
                take, bins = fits, full
            else:
                take, bins = n, 1
            group[0] -= bins
            if not group[0]:
                open_bins[room].pop()
            open_bins.setdefault(room - take * length, []).append([bins, group[1] + (length,) * take])
            n -= take * bins
    return [(m, p) for groups in open_bins.values() for m, p in groups]


def fewest(counts: np.ndarray, capacity: int) -> int:
    """No packing needs fewer bins: documents over half a bin have one each, and for every k those of k
    or more that are no longer than half fit only beside the ones that leave k of room."""
    have = np.asarray(counts, dtype=np.int64)
    number, size = np.cumsum(have), np.cumsum(have * np.arange(capacity + 1))
    half, k = capacity // 2, np.arange(1, capacity // 2 + 1)
    room = (number[capacity - k] - number[half]) * capacity - (size[capacity - k] - size[half])
    over = np.maximum(size[half] - size[k - 1] - room, 0)
    return max(-(-int(size[-1]) // capacity), int(number[-1] - number[half]) + int((-(-over // capacity)).max(initial=0)))


def _dominated(filling: tuple[int, ...], slack: int, lengths: list[int], counts: list[int]) -> bool:
    """Could one document left out replace some of the filling, taking no less room, and still fit?"""
    if len(filling) > 10:
        return False
    sums = {}
    for x in filling:
        for s, k in list(sums.items()):
            sums[s + x] = max(sums.get(s + x, 0), k + 1)
        sums[x] = max(sums.get(x, 0), 1)
    for s, k in sums.items():
        low = bisect_left(lengths, s if k > 1 else s + 1)
        for i in range(low, bisect_right(lengths, s + slack)):
            if counts[lengths[i]] > filling.count(lengths[i]):
                return True
    return False


def fillings(room: int, lengths: list[int], counts: list[int], most_waste: int) -> list[tuple[int, tuple[int, ...]]]:
    """(waste, filling) of undominated fillings of ``room``, least waste and fewest documents first.

    The walk ends once a few leave no room, or after ``FILL_NODES`` steps; a filling that the end
    of the walk left unfinished does not count.
    """
    found: dict[tuple[int, ...], int] = {}
    nodes = exact = 0

    def grow(left: int, top: int, chosen: tuple[int, ...]) -> None:
        nonlocal nodes, exact
        i = bisect_right(lengths, min(left, top)) - 1
        grown = False
        while i >= 0 and exact < FILL_KEEP:
            x = lengths[i]
            if counts[x] > chosen.count(x):
                grown = True
                if nodes >= FILL_NODES:
                    return
                nodes += 1
                grow(left - x, x, (*chosen, x))
            i -= 1
        if not grown and exact < FILL_KEEP and left <= most_waste and chosen not in found and not _dominated(
                chosen, left, lengths, counts):
            found[chosen] = left
            exact += left == 0

    grow(room, room, ())
    if not found:  # every filling seen was too wasteful or unfinished: give the plainest
        left, chosen, i = room, [], bisect_right(lengths, room) - 1
        while i >= 0:
            x = lengths[i]
            take = min(left // x, counts[x])
            chosen += [x] * take
            left -= x * take
            i -= 1
        found[tuple(chosen)] = left
    return sorted(((w, f) for f, w in found.items()), key=lambda x: (x[0], len(x[1])))[:FILL_KEEP]


def bin_completion(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Patterns that hold every counted length once, in as few bins as the search finds."""
    total = int((np.arange(capacity + 1) * counts).sum())
    if not total:
        return []
    incumbent = best_fit(counts, capacity)
    best = sum(m for m, _ in incumbent)
    least = fewest(counts, capacity)
    have = [int(c) for c in counts]
    lengths = [x for x in range(1, capacity + 1) if have[x]]
    most = SEARCH_NODES + NODES_A_LENGTH * len(lengths)
    nodes, left, bins = 0, total, 0
    # one frame for each pattern that is applied: the fillings still to try in its place, and the pattern itself
    frames: list[tuple[list[tuple[int, ...]], Pattern | None]] = []

    def options() -> list[tuple[int, ...]]:
        """Bins to try next, the best one last; none where the incumbent cannot be beaten."""
        if not left or bins - (-left // capacity) >= best:
            return []
        top = lengths[-1]
        have[top] -= 1
        found = fillings(capacity - top, lengths, have, max((best - 1 - bins) * capacity - left, 0))
        have[top] += 1
        return [(top, *filling) for _, filling in reversed(found)]

    def apply(bin_: tuple[int, ...], times: int) -> None:
        """Take ``times`` such bins out of the counts, or put them back (below zero)."""
        nonlocal left, bins
        for x in bin_:
            have[x] -= times
            at = bisect_left(lengths, x)
            there = at < len(lengths) and lengths[at] == x
            if there and not have[x]:
                del lengths[at]
            elif not there and have[x]:
                lengths.insert(at, x)
        left -= times * sum(bin_)
        bins += times

    frames.append((options(), None))
    while frames and best > least and nodes < most:
        untried, done = frames.pop()
        if done:
            apply(done[1], -done[0])
        if not untried:
            continue
        nodes += 1
        bin_ = untried.pop()
        times = min(have[x] // bin_.count(x) for x in set(bin_))
        apply(bin_, times)
        frames.append((untried, (times, bin_)))
        if not left and bins < best:
            best, incumbent = bins, [pattern for _, pattern in frames if pattern]
        frames.append((options(), None))
    return incumbent
