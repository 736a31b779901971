"""Packing plan over a length histogram (no Spark here).

Minimise sequences: choose how often to use each configuration, a multiset of lengths that fits the
capacity, so that every piece is used. The configuration program is solved over classes of like
lengths by multiplicative weights: weights fall exponentially with how far a class is covered, and
the next configuration is the most valuable one under them, found by knapsack dynamic programming.
The fractional solution is rounded by running sums, so that like configurations share their fractions and
hardly any use is lost; every whole use is realised with pieces of its classes, the
last of them being whichever length left fits best. What the program leaves, lengths whose classes ran out, is packed by
best fit. That is done with the configurations that fill their sequences and with all; the plan with fewest sequences is
taken.

All loops run over lengths and classes, at most ``capacity`` of them, with multiplicities: a step
uses up a length, so the plan's size doesn't grow with the number of documents.
"""

from __future__ import annotations

import numpy as np

#: A segment of the plan: pieces of ``length`` with ranks [first, last) go, ``each`` a sequence, to
#: sequences from ``sequence`` on, the first at ``offset`` in its sequence.
SEGMENT = ("length", "first", "last", "each", "sequence", "offset")


def classes(counts: np.ndarray, n_classes: int) -> np.ndarray:
    """Class of each length (-1: none): runs of lengths with about equal numbers of tokens."""
    mass = counts * np.arange(len(counts))
    upto = np.cumsum(mass) - mass / 2
    out = np.full(len(counts), -1)
    present = np.flatnonzero(counts)
    raw = np.minimum((upto[present] / max(mass.sum(), 1) * n_classes).astype(int), n_classes - 1)
    out[present] = np.unique(raw, return_inverse=True)[1]
    return out


def price(sizes: np.ndarray, values: np.ndarray, cells: int) -> np.ndarray:
    """Copies of each class in a most valuable configuration of at most ``cells`` cells."""
    best, took = np.zeros(cells + 1), np.full(cells + 1, -1)
    least = int(sizes.min())
    for c in range(least, cells + 1):
        fits = np.flatnonzero(sizes <= c)
        gain = best[c - sizes[fits]] + values[fits]
        k = int(gain.argmax())
        if gain[k] > best[c - 1]:
            best[c], took[c] = gain[k], fits[k]
        else:
            best[c] = best[c - 1]
    use, c = np.zeros(len(sizes), int), cells
    while c >= least:
        if took[c] < 0:
            c -= 1
        else:
            use[took[c]] += 1
            c -= sizes[took[c]]
    return use


def configuration_lp(sizes: np.ndarray, demand: np.ndarray, cells: int, step: float, rounds: int) -> list[tuple[np.ndarray, float]]:
    """A near-optimal fractional cover of ``demand``: (configuration, times used).

    Each round raises one configuration until a class has gained ``step`` of its demand. Ends when
    all classes are covered, or after ``rounds``; uses are scaled to cover exactly.
    """
    covered = np.zeros(len(sizes))
    rate = np.log(len(sizes) + 1) / (4 * step)
    found: dict[bytes, list] = {}
    for _ in range(rounds):
        if covered.min() >= 1:
            break
        weight = np.exp(-rate * (covered - covered.min())) / demand
        weight[covered >= 1.0 + step] = 0.0
        use = price(sizes, weight, cells)
        some = use > 0
        times = float((step * demand[some] / use[some]).min())
        covered[some] += use[some] * times / demand[some]
        entry = found.setdefault(use.tobytes(), [use, 0.0])
        entry[1] += times
    scale = 1 / max(1.0, float(np.median(covered))) if len(covered) else 1.0
    return [(use, times * scale) for use, times in found.values()]


def rounded(solved: list[tuple[np.ndarray, float]]) -> list[tuple[np.ndarray, int]]:
    """Whole uses of each configuration: the whole part of the running sum of all uses, in order of their largest classes.

    All uses of any stretch of that order differ from their sum by less than one.
    """
    out, total = [], 0.0
    for use, times in sorted(solved, key=lambda x: (-int(np.flatnonzero(x[0])[-1]), x[0].tolist()[::-1])):
        before, total = int(total + 1e-9), total + times
        if (k := int(total + 1e-9) - before) > 0:
            out.append((use, k))
    return out


class Plan:
    """Segments written so far and the pieces still unused."""

    def __init__(self, counts: np.ndarray, capacity: int) -> None:
        self.left, self.capacity = counts.astype(np.int64).copy(), capacity
        self.used = np.zeros(len(counts), np.int64)
        self.sequences, self.segments = 0, []
        self.configured = 0  # sequences that came from configurations
        self.have = sum(1 << int(n) for n in np.flatnonzero(self.left))  # bit n: length n is left

    def longest(self, most: int) -> int:
        """Longest length left of at most ``most`` (0: none)."""
        return max((self.have & ((1 << (most + 1)) - 1)).bit_length() - 1, 0)

    def complete(self, chosen: dict[int, int]) -> dict[int, int]:
        """``chosen`` filled up, each time by the longest piece that still fits."""
        room = self.capacity - sum(n * k for n, k in chosen.items())
        while room > 0 and (n := self.longest(room)):
            spare = int(self.left[n]) - chosen.get(n, 0)
            if spare <= 0:  # used up inside this very sequence: look below
                below = n - 1
                while (n := self.longest(below)) and self.left[n] <= chosen.get(n, 0):
                    below = n - 1
                if not n:
                    break
                spare = int(self.left[n]) - chosen.get(n, 0)
            k = min(room // n, spare)
            chosen[n] = chosen.get(n, 0) + k
            room -= n * k
        return chosen

    def emit(self, chosen: dict[int, int], most: int | None = None) -> int:
        """Use ``chosen`` as often as its lengths last, ``most`` times at most."""
        times = min(int(self.left[n]) // k for n, k in chosen.items())
        times = times if most is None else min(times, most)
        offset = 0
        for n, k in sorted(chosen.items(), reverse=True):
            first = int(self.used[n])
            self.segments.append((n, first, first + times * k, k, self.sequences, offset))
            offset += n * k
            self.used[n] += times * k
            self.left[n] -= times * k
            if not self.left[n]:
                self.have &= ~(1 << n)
        self.sequences += times
        return times


def _realise(plan: Plan, members: list[np.ndarray], solved: list[tuple[np.ndarray, int]], full: bool) -> Plan:
    """``plan`` with the uses of each configuration, and best fit for what is left.

    With ``full`` a configuration ends once its lengths leave room; else once they run out.
    """
    for use, times in sorted(solved, key=lambda x: (-int(np.flatnonzero(x[0])[-1]), -x[1])):
        whole = times
        while whole > 0:
            chosen: dict[int, int] = {}
            room = plan.capacity
            picks = np.repeat(np.arange(len(members)), use)[::-1].tolist()  # longest class first
            first = picks[: max(len(picks) - 1, 1)]
            for g in first:
                low, top = int(members[g][0]), min(int(members[g][-1]), room)
                while (m := plan.longest(top)) >= low and plan.left[m] <= chosen.get(m, 0):
                    top = m - 1
                if m < low or not m:
                    break
                chosen[m] = chosen.get(m, 0) + 1
                room -= m
            found = sum(chosen.values()) == len(first)
            if not chosen:
                break
            tokens = sum(m * k for m, k in plan.complete(chosen).items())
            if tokens < plan.capacity and (full or not found or sum(chosen.values()) < len(picks)):
                break  # its lengths no longer fill a sequence: best fit may use them better
            whole -= plan.emit(chosen, whole)
    plan.configured = plan.sequences
    while top := plan.longest(plan.capacity):
        plan.emit(plan.complete({top: 1}))
    return plan


def solve(counts: np.ndarray, capacity: int, n_classes: int = 64, step: float = 0.05, cell: int = 16, rounds: int = 4000) -> Plan:
    """The plan that places every piece of ``counts`` (pieces by length, to ``capacity``), by the configuration program.

    Of the plans with full configurations only and with all of them, the one with fewest sequences.
    """
    counts = np.asarray(counts, np.int64)
    group = classes(counts, n_classes)
    n = int(group.max(initial=-1)) + 1
    members, solved = [np.flatnonzero(group == g) for g in range(n)], []
    if n:
        demand = np.array([counts[m].sum() for m in members], float)
        mean = np.array([(counts[m] * m).sum() for m in members]) / demand
        sizes = np.maximum(np.round(mean / cell).astype(int), 1)
        solved = rounded(configuration_lp(sizes, demand, capacity // cell, step, rounds))
    return min((_realise(Plan(counts, capacity), members, solved, full) for full in (True, False)), key=lambda p: p.sequences)


def make_plan(counts: np.ndarray, capacity: int, n_classes: int = 64, **how) -> tuple[np.ndarray, int]:
    """(segments, sequences) of ``solve``."""
    plan = solve(counts, capacity, n_classes, **how)
    return np.array(plan.segments, np.int64).reshape(-1, len(SEGMENT)), plan.sequences
