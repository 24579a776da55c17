"""Cutting-stock plans by column generation over a histogram of piece lengths.

A pattern says how many pieces of each length share one sequence. The linear program asks for the
cheapest fractional use of patterns that holds every piece; its columns are priced by an unbounded
knapsack over the dual values of the lengths, so no list of patterns is ever made. The fractions are
rounded down, and what is left over, less than one sequence of each pattern in use, is laid out by
exact subset sums. All work is bounded by the capacity: there are at most `capacity` lengths.

A sequence is padded to the capacity unless its total is a power of two; `SEQUENCE_COST` tokens are
charged for each sequence, so that short ones are taken only where they save padding.
"""

from __future__ import annotations

import numpy as np

Pattern = dict[int, int]

SEQUENCE_COST = 16
# The program ends within this share of its lower bound, or when `PATIENCE` rounds of pricing gain
# less than that.
GAP = 0.002
PATIENCE = 30
EPSILON = 1e-9


def padded(total: int, capacity: int) -> int:
    """Tokens of a sequence with its padding."""
    return total if total & (total - 1) == 0 else capacity


def _costs(capacity: int) -> np.ndarray:
    """Cost of a sequence by its total; nothing costs nothing."""
    return np.array([0.0] + [float(padded(t, capacity) + SEQUENCE_COST)
                             for t in range(1, capacity + 1)])


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int
             ) -> tuple[np.ndarray, np.ndarray]:
    """Greatest value of pieces that fill each total exactly, and the last piece put there.

    `lengths` ascend. Totals that no pieces fill have the value minus infinity.
    """
    best = np.full(capacity + 1, -np.inf)
    best[0] = 0.0
    last = np.full(capacity + 1, -1)
    usable = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for total in range(int(lengths[0]), capacity + 1):
        within = usable[total]
        worth = best[total - lengths[:within]] + values[:within]
        at = int(worth.argmax())
        if worth[at] > -np.inf:
            best[total], last[total] = worth[at], at
    return best, last


def _column(last: np.ndarray, lengths: np.ndarray, total: int) -> np.ndarray:
    column = np.zeros(len(lengths))
    while total:
        column[last[total]] += 1
        total -= int(lengths[last[total]])
    return column


def _filled(left: Pattern, room: int) -> Pattern:
    """Pieces out of `left` that fill the room as far as any choice of them can."""
    reach, steps = 1, []
    for length in sorted(left, reverse=True):
        for _ in range(min(left[length], room // length)):
            wider = reach | (reach << length) & ((1 << (room + 1)) - 1)
            if wider == reach:
                break
            steps.append((length, reach))
            reach = wider
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + 1
            total -= length
    return taken


def _start(lengths: np.ndarray, demand: np.ndarray, capacity: int
           ) -> tuple[np.ndarray, np.ndarray]:
    """A basis: the longest piece left with the best filling beside it, until a length runs out.

    Each pattern uses up one length that no later one holds, so they are linearly independent.
    """
    m = len(lengths)
    place = {int(k): i for i, k in enumerate(lengths)}
    patterns, used = np.diag((capacity // lengths).astype(float)), np.zeros(m)
    left = {int(k): float(n) for k, n in zip(lengths, demand)}
    while left:
        longest = max(left)
        others = {k: capacity for k in left}
        pattern = _filled(others, capacity - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times, ends = min((left[k] / n, k) for k, n in pattern.items())
        row = place[ends]
        patterns[row] = 0
        for k, n in pattern.items():
            patterns[row, place[k]] = n
            left[k] -= n * times
        used[row] = times
        for k in [k for k in pattern if left[k] <= EPSILON or k == ends]:
            del left[k]
    return patterns, used


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP,
          columns_a_round: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one a row) and how often each is used, as fractions.

    The revised simplex method over columns that the knapsack prices. Farley's bound and the number
    of tokens tell how far the best can be.
    """
    costs = _costs(capacity)
    patterns, used = _start(lengths, demand, capacity)
    price = costs[(patterns @ lengths).astype(int)]
    inverse = np.linalg.inv(patterns.T)
    floor = float((lengths * demand).sum()) * min(
        costs[t] / t for t in range(1, capacity + 1))
    values = []
    while True:
        duals = price @ inverse
        value = float(price @ used)
        values.append(value)
        best, last = knapsack(lengths, duals, capacity)
        ratio = float((best[1:] / costs[1:]).max())
        floor = max(floor, value / max(ratio, 1.0))
        if value <= floor * (1 + gap) or ratio <= 1 + EPSILON:
            return patterns, used
        if len(values) > PATIENCE and values[-PATIENCE - 1] - value <= gap * value:
            return patterns, used
        gain = best - costs
        for total in np.argsort(-gain)[:columns_a_round]:
            if gain[total] <= EPSILON:
                break
            column = _column(last, lengths, int(total))
            if float(duals @ column) - costs[total] <= EPSILON * costs[total]:
                continue
            some = np.flatnonzero(column)
            step = inverse[:, some] @ column[some]
            leaving = np.flatnonzero(step > EPSILON)
            row = leaving[np.argmin(used[leaving] / step[leaving])]
            amount = used[row] / step[row]
            used -= amount * step
            used[row] = amount
            np.maximum(used, 0.0, out=used)
            # The duals and the inverse follow from the pivot row alone.
            pivot = inverse[row] / step[row]
            where = np.flatnonzero(pivot)
            duals[where] += (costs[total] - float(price @ step)) * pivot[where]
            touched = np.flatnonzero(np.abs(step) > 1e-12)
            inverse[np.ix_(touched, where)] -= np.outer(step[touched], pivot[where])
            inverse[row] = pivot
            patterns[row], price[row] = column, costs[total]


def _leftovers(left: Pattern, capacity: int) -> list[tuple[Pattern, int]]:
    """Sequences for what rounding leaves: the longest piece, then the best filling beside it."""
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        pattern = _filled({k: n for k, n in left.items() if n}, capacity - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[k] // n for k, n in pattern.items())
        for k, n in pattern.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        plan.append((pattern, times))
    return plan


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns and how many sequences follow each, holding exactly the pieces of the histogram.

    Lengths are 1 .. capacity; pieces of full length are sequences of their own. An empty histogram
    gives an empty plan.
    """
    left = {int(k): int(n) for k, n in histogram.items() if n}
    whole = left.pop(capacity, 0)
    found = [({capacity: 1}, whole)] if whole else []
    if left:
        lengths = np.array(sorted(left))
        demand = np.array([left[k] for k in lengths], float)
        patterns, used = solve(lengths, demand, capacity)
        # A share of a sequence that arithmetic alone takes away is no reason to round it down.
        for pattern, times in zip(patterns, np.floor(used + 1e-6).astype(int).tolist()):
            pieces = {int(lengths[i]): int(pattern[i]) for i in np.flatnonzero(pattern)}
            times = min([times, *(left.get(k, 0) // n for k, n in pieces.items())])
            if times:
                found.append((pieces, times))
                for k, n in pieces.items():
                    left[k] -= n * times
        found += _leftovers({k: n for k, n in left.items() if n}, capacity)
    return found
