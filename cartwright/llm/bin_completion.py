"""Packing sizes into as few bins as possible, on the numbers of items of each size.

All steps work on counts: a pattern (how many items of which sizes share a bin) is used for many bins at once, so the
work depends on the number of different sizes, not on the number of items.

Best fit, in decreasing order of size, gives the first solution. If it has more bins than the lower
bound, bin completion looks for better ones: the bin of the largest item left is completed by a filling
of smaller items, fillings that another one dominates are left out, and a branch ends when the
space it has wasted cannot lead to fewer bins than the best solution so far. Now and then the rest is packed by best fit, which
may give a new best solution. The search ends when the bound is reached, when nothing is
left to try, or after ``steps`` steps (then the best solution so far stands).
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np

Pattern = tuple[tuple[int, int], ...]  # (size, items of it in a bin)

#: Steps of the search, each an item put into or taken out of a filling, or a filling tried.
STEPS = 100_000
#: A filling that is tried costs as much as so many steps.
TRIED = 50
#: Of so many fillings, one has its rest packed by best fit.
REFIT = 25
#: Fillings that are looked at before the tightest of them is tried.
AHEAD = 64


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's second bound: large items apart, what the others need beyond their space."""
    number = np.zeros(capacity + 2, np.int64)
    for size, n in counts.items():
        number[size] = n
    total = number * np.arange(capacity + 2)
    above = lambda x: x[::-1].cumsum()[::-1]  # noqa: E731  sums from a size on
    n_from, t_from = above(number), above(total)
    k = np.arange(capacity // 2 + 1)
    half = capacity // 2 + 1
    alone = n_from[capacity - k + 1]  # too large to share with an item of k or more
    middle_n, middle_t = n_from[half] - alone, t_from[half] - t_from[capacity - k + 1]
    small_t = t_from[np.minimum(k, half)] - t_from[half]
    over = small_t - (middle_n * capacity - middle_t)
    return int((alone + middle_n + np.maximum(0, -(-over // capacity))).max())


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit decreasing: (pattern, number of bins)."""
    patterns: list[tuple[int, int, int]] = []  # (pattern before, size, items)
    rooms: list[int] = []
    groups: dict[int, list[tuple[int, int]]] = {}

    def put(room: int, pattern: int, bins: int) -> None:
        if bins:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((pattern, bins))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                before, bins = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, before, bins = capacity, -1, -(-left // (capacity // size))
            # The tightest bin that takes one more stays the tightest until it takes no more.
            each = room // size
            full = min(bins, left // each)
            rest = min(left - full * each, each) if full < bins else 0
            put(room, before, bins - full - (rest > 0))
            for n, m in ((full, each), (1, rest)):
                if n and m:
                    patterns.append((before, size, m))
                    put(room - m * size, len(patterns) - 1, n)
            left -= full * each + rest
    out = []
    for same in groups.values():
        for pattern, bins in same:
            items = []
            while pattern >= 0:
                pattern, size, n = patterns[pattern]
                items.append((size, n))
            out.append((tuple(reversed(items)), bins))
    return out


def _dominated(filling: Pattern, waste: int, left: dict[int, int], sizes: list[int]) -> bool:
    """Whether a larger item could take the place of one, or one the place of two of few, within the waste."""
    items = [size for size, _ in filling]
    targets = [(x, x + 1) for x in items]
    if len(items) <= 6:
        targets += [(x, x) for x in (a + b for i, a in enumerate(items) for b in items[i + 1 :])]
        targets += [(2 * a, 2 * a) for a, n in filling if n > 1]
    used = dict(filling)
    for x, least in targets:
        for at in range(bisect_left(sizes, least), bisect_left(sizes, x + waste + 1)):
            if left[sizes[at]] > used.get(sizes[at], 0):
                return True
    return False


class Budget:
    """Steps that are left to a search."""

    def __init__(self, steps: int):
        self.left = steps

    def spend(self, steps: int = 1) -> bool:
        self.left -= steps
        return self.left >= 0


def fillings(
    room: int, left: dict[int, int], sizes: list[int], most_waste: int, budget: Budget
) -> Iterator[tuple[Pattern, int]]:
    """Undominated ways to fill ``room`` with items left, large items first, and what each wastes.

    ``sizes`` is in increasing order.
    """

    def fill(room: int, at: int, so_far: Pattern) -> Iterator[tuple[Pattern, int]]:
        at = min(at, bisect_left(sizes, room + 1) - 1)
        tight = True
        for i in range(at, -1, -1):
            for n in range(min(left[sizes[i]], room // sizes[i]), 0, -1):
                if not budget.spend():
                    return
                tight = False
                yield from fill(room - n * sizes[i], i - 1, (*so_far, (sizes[i], n)))
        if tight and room <= most_waste and not _dominated(so_far, room, left, sizes):
            yield so_far, room

    yield from fill(room, len(sizes) - 1, ())


def tightest_first(found: Iterator[tuple[Pattern, int]]) -> Iterator[tuple[Pattern, int]]:
    """The same in stretches, each in order of waste; a filling that wastes nothing ends a stretch."""
    stretch: list[tuple[Pattern, int]] = []
    for filling, lost in found:
        stretch.append((filling, lost))
        if not lost or len(stretch) == AHEAD:
            yield from sorted(stretch, key=lambda x: x[1])
            stretch = []
    yield from sorted(stretch, key=lambda x: x[1])


def bin_completion(counts: dict[int, int], capacity: int, steps: int = STEPS) -> list[tuple[Pattern, int]]:
    """Patterns with their numbers of bins; together they hold ``counts`` items of each size."""
    counts = {size: n for size, n in counts.items() if n}
    best = best_fit(counts, capacity)
    fewest = sum(n for _, n in best)
    bound = lower_bound(counts, capacity)
    total = sum(size * n for size, n in counts.items())
    budget, tried = Budget(steps), 0

    def branches(left: dict[int, int], chosen: tuple, bins: int, waste: int) -> Iterator[tuple]:
        """What remains after each filling around the largest item, as arguments of a further call."""
        nonlocal best, fewest, tried
        sizes = sorted(left)
        largest = sizes[-1]
        rest = dict(left)
        rest[largest] -= 1
        if not rest[largest]:
            del rest[largest]
            sizes.pop()
        # One bin fewer than the best has this much space to waste.
        found = fillings(capacity - largest, rest, sizes, (fewest - 1) * capacity - total - waste, budget)
        for filling, lost in tightest_first(found):
            pattern = dict(filling)
            pattern[largest] = pattern.get(largest, 0) + 1
            times = min(left[size] // n for size, n in pattern.items())
            while times:
                tried += 1
                if not budget.spend(TRIED):
                    return
                spare = (fewest - 1) * capacity - total - waste
                if lost * times <= spare and bins + times < fewest:
                    after = {size: n - times * pattern.get(size, 0) for size, n in left.items()}
                    after = {size: n for size, n in after.items() if n}
                    taken = (chosen, (tuple(sorted(pattern.items(), reverse=True)), times))
                    if bins + times + lower_bound(after, capacity) < fewest:
                        quick = best_fit(after, capacity) if not after or tried % REFIT == 1 else None
                        if quick is not None and bins + times + sum(n for _, n in quick) < fewest:
                            best, fewest = quick, bins + times + sum(n for _, n in quick)
                            while taken:
                                taken, last = taken
                                best.append(last)
                            taken = (chosen, (tuple(sorted(pattern.items(), reverse=True)), times))
                        if after:
                            yield after, taken, bins + times, waste + lost * times
                times //= 2

    open_branches = [branches(counts, (), 0, 0)] if fewest > bound else []
    while open_branches and fewest > bound and budget.left > 0:
        deeper = next(open_branches[-1], None)
        if deeper is None:
            open_branches.pop()
        else:
            open_branches.append(branches(*deeper))
    return best
