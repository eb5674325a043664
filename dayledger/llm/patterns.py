"""Cutting stock by column generation: how many sequences of which pattern a histogram needs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PRICINGS = 200  # at most: what the program has not found by then is packed largest size first
Pattern = tuple[tuple[int, int], ...]  # (size, copies), largest size first


def best_values(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The dearest multiset of sizes that fits each capacity, by dynamic programming: its value, and the
    size added last (-1: none). Sizes ascend."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for used in range(1, capacity + 1):
        best[used] = best[used - 1]
        k = fitting[used]
        if k:
            values = best[used - sizes[:k]] + prices[:k]
            i = int(values.argmax())
            if values[i] > best[used] + 1e-12:
                best[used], taken[used] = values[i], i
    return best, taken


def multiset(sizes: np.ndarray, taken: np.ndarray, capacity: int) -> np.ndarray:
    """The copies of each size in the dearest multiset for a capacity."""
    copies = np.zeros(len(sizes))
    used = capacity
    while used > 0:
        if taken[used] < 0:
            used -= 1
        else:
            copies[taken[used]] += 1
            used -= sizes[taken[used]]
    return copies


def best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    best, taken = best_values(sizes, prices, capacity)
    return float(best[capacity]), multiset(sizes, taken, capacity)


def largest_first(sizes: np.ndarray, left: np.ndarray, capacity: int) -> Iterator[tuple[np.ndarray, int]]:
    """Patterns filled from the largest size down, and how often each, until nothing is left."""
    left = left.copy()
    while left.any():
        copies, room = np.zeros(len(sizes), dtype=np.int64), capacity
        for i in np.flatnonzero(left)[::-1]:
            copies[i] = min(left[i], room // sizes[i])
            room -= copies[i] * sizes[i]
        some = copies > 0
        times = int((left[some] // copies[some]).min())
        left -= copies * times
        yield copies, times


def relaxed(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 2e-3) -> tuple[np.ndarray, np.ndarray]:
    """The linear program: columns of copies and how often each is used. Begins with the patterns that
    are filled largest size first. Stops when no solution uses `gap` fewer sequences, as a share: by Farley's
    bound, or since all sizes together fill so many; or after PRICINGS. One pricing gives the dearest pattern
    with each size in it; some of those enter one after the other while they are still worth it."""
    m = len(sizes)
    fit = (capacity // sizes).astype(float)
    columns = np.diag(fit)
    inverse = np.diag(1 / fit)
    used = demand / fit
    prices = inverse.sum(axis=0)  # each sequence costs 1

    def enter(new: np.ndarray) -> None:
        nonlocal used, prices, inverse
        if prices @ new <= 1 + gap / 2:
            return
        step = inverse @ new
        rises = step > 1e-9
        ratios = np.full(m, np.inf)
        ratios[rises] = used[rises] / step[rises]
        out = int(ratios.argmin())
        used = np.maximum(used - ratios[out] * step, 0)
        used[out] = ratios[out]
        columns[:, out] = new
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        prices = inverse.sum(axis=0)

    for new, _ in largest_first(sizes, demand.astype(np.int64), capacity):
        enter(new.astype(float))
    filled = float(sizes @ demand) / capacity
    for _ in range(PRICINGS):
        if used.sum() <= (1 + gap) * filled:
            break
        best, taken = best_values(sizes, prices, capacity)
        if best[capacity] <= 1 + gap:
            break
        with_size = prices + best[capacity - sizes]
        for i in np.argsort(-with_size, kind="stable")[: max(16, m // 4)]:
            new = multiset(sizes, taken, int(capacity - sizes[i]))
            new[i] += 1
            enter(new)
    return columns, used


def cutting_stock(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns and how many sequences follow each; together they hold exactly the histogram.

    The linear program is rounded down; what is left over, about one sequence per pattern, is filled
    largest size first.
    """
    sizes = np.array(sorted(s for s, n in histogram.items() if n > 0), dtype=np.int64)
    if not len(sizes):
        return []
    left = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    columns, used = relaxed(sizes, left.astype(float), capacity)
    plan: list[tuple[Pattern, int]] = []

    def take(copies: np.ndarray, times: int) -> None:
        nonlocal left
        left = left - copies * times
        plan.append((tuple((int(sizes[i]), int(copies[i])) for i in np.flatnonzero(copies)[::-1]), int(times)))

    for column, times in zip(columns.T.round().astype(np.int64), np.floor(used + 1e-9).astype(np.int64), strict=True):
        some = column > 0
        times = min(int(times), int((left[some] // column[some]).min())) if some.any() else 0
        if times > 0:
            take(column, times)
    for copies, times in largest_first(sizes, left, capacity):
        take(copies, times)
    return plan
