"""Ranges of a numeric key that hold about as many rows each, worked out from counts only."""

from __future__ import annotations

from collections.abc import Callable

#: Equal steps into which a range that holds too much is cut at a time.
STEPS = 256

#: (low, step) -> rows for each step of a range [low, high): ``counts(low, high, step)`` gives {step number: rows}.
Counts = Callable[[int, int, int], dict[int, int]]


def balanced_ranges(low: int, high: int, n: int, counts: Counts, parts: int, steps: int = STEPS) -> list[tuple[int, int]]:
    """Half-open ranges that cover low..high in order, none over its share of ``n`` unless a single key is.

    A range with more rows than its share is cut into equal steps, and those
    that still hold too much again, as often as their width allows; then
    neighbours are joined while they stay within the share.  A key that has
    more than a share by itself is a range alone: it can't be cut by key.
    Each cut costs one count; a step without rows costs nothing more.
    """
    share = max(1, -(-n // max(parts, 1)))
    fine: list[tuple[int, int, int]] = []
    todo = [(low, high + 1, n)]
    while todo:
        a, b, k = todo.pop()
        if k <= share or b - a == 1:
            fine.append((a, b, k))
            continue
        step = max(1, -(-(b - a) // steps))
        held = counts(a, b, step)
        todo += [(x, min(x + step, b), held.get(i, 0)) for i, x in enumerate(range(a, b, step))]
    out: list[list[int]] = []
    for a, b, k in sorted(fine):
        if out and out[-1][2] + k <= share:
            out[-1][1:] = [b, out[-1][2] + k]
        else:
            out.append([a, b, k])
    return [(a, b) for a, b, _ in out]


def predicates(key: str, ranges: list[tuple[int, int]], nulls: bool) -> list[str]:
    """A condition for each range, and one for rows without a key: every row meets exactly one.

    The outer ends are open, so rows that come in while the plan is made are
    read as well.
    """
    if not ranges:
        return [f"{key} IS NULL"] if nulls else ["1 = 1"]
    out = []
    for i, (a, b) in enumerate(ranges):
        ends = ([f"{key} >= {a}"] if i else []) + ([f"{key} < {b}"] if i < len(ranges) - 1 else [])
        out.append(" AND ".join(ends) or f"{key} IS NOT NULL")
    return out + [f"{key} IS NULL"] * nulls


def bounds_query(table: str, key: str) -> str:
    return f"SELECT MIN({key}) AS low, MAX({key}) AS high, COUNT({key}) AS n, COUNT(*) AS total FROM {table}"


def counts_query(table: str, key: str, low: int, high: int, step: int) -> str:
    at = f"FLOOR(({key} - {low}) / {step})"
    return f"SELECT {at} AS step, COUNT(*) AS n FROM {table} WHERE {key} >= {low} AND {key} < {high} GROUP BY {at}"
