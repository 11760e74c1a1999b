"""Cutting stock by column generation, over a histogram of lengths.

The linear program chooses how often to use each pattern (a multiset of
lengths that fits into one sequence), so that the patterns hold every piece
and as few sequences as possible are used.  Its columns are not listed: a
knapsack over the dual prices finds the next pattern that would help.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

Pattern = tuple[tuple[int, int], ...]  # (length, times), longest first


def priced_pattern(lengths: np.ndarray, prices: np.ndarray, capacity: int):
    """(value, times per length) of the best pattern, by dynamic programming."""
    worth = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(lengths, room, "right")
        worth[room] = worth[room - 1]
        if fits:
            options = worth[room - lengths[:fits]] + prices[:fits]
            best = int(options.argmax())
            if options[best] > worth[room]:
                worth[room], taken[room] = options[best], best
    times, room = np.zeros(len(lengths)), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            times[taken[room]] += 1
            room -= lengths[taken[room]]
    return worth[capacity], times


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, tolerance: float = 1e-4):
    """(patterns as columns, their fractional use) at the optimum.

    Revised simplex from the patterns of one length each; the loop ends as no
    pattern is worth more than the sequence it costs, up to ``tolerance``.
    """
    basis = np.diag((capacity // lengths).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    use = inverse @ demand
    while True:
        value, column = priced_pattern(lengths, inverse.sum(0), capacity)
        if value <= 1 + tolerance:
            return basis, use
        change = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(change > 1e-9, use / change, np.inf)
        leaves = int(ratio.argmin())
        use = np.maximum(use - ratio[leaves] * change, 0)
        use[leaves] = ratio[leaves]
        row = inverse[leaves] / change[leaves]
        inverse -= np.outer(change, row)
        inverse[leaves] = row
        basis[:, leaves] = column


def best_fit(lengths: list[int], capacity: int) -> Counter[Pattern]:
    """Patterns for the few pieces that rounding leaves, longest first."""
    rooms: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    for length in sorted(lengths, reverse=True):
        room = next((r for r in range(length, capacity) if rooms[r]), capacity)
        held = rooms[room].pop() if rooms[room] else []
        held.append(length)
        rooms[room - length].append(held)
    patterns = (held for same in rooms for held in same)
    return Counter(tuple(sorted(Counter(x).items(), reverse=True)) for x in patterns)


def patterns_for(histogram: dict[int, int], capacity: int) -> Counter[Pattern]:
    """How often to use which pattern, so that exactly all pieces are held.

    The optimum is rounded down; what is left is less than one sequence for
    each length and is packed by best fit.
    """
    if not histogram:
        return Counter()
    lengths = np.array(sorted(histogram))
    demand = np.array([histogram[length] for length in lengths.tolist()], float)
    columns, use = solve(lengths, demand, capacity)
    whole = np.floor(use + 1e-9).astype(np.int64)
    columns = columns.round().astype(np.int64)
    over = columns @ whole - demand.astype(np.int64)
    while (over > 0).any():  # by rounding errors of the simplex alone
        worst = int(over.argmax())
        whole[int(np.flatnonzero((columns[worst] > 0) & (whole > 0))[0])] -= 1
        over = columns @ whole - demand.astype(np.int64)
    left = np.repeat(lengths, -over).tolist()
    found = best_fit(left, capacity)
    for j in np.flatnonzero(whole):
        held = np.flatnonzero(columns[:, j])[::-1]
        pattern = tuple((int(lengths[i]), int(columns[i, j])) for i in held)
        found[pattern] += int(whole[j])
    return found
