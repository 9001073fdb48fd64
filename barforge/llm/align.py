"""Bit-parallel alignments on Python integers: one bit per place of a band.

``edit_distance`` compares two sequences inside a band of diagonals that is as
wide as the edit budget allows; ``find_within`` finds a pattern inside a text
slice.  Both work on any hashable symbols (characters or word hashes).
"""

from __future__ import annotations

from collections.abc import Hashable, Sequence


def _places(pattern: Sequence[Hashable]) -> dict[Hashable, int]:
    masks: dict[Hashable, int] = {}
    by_symbol: dict[Hashable, list[int]] = {}
    for k, c in enumerate(pattern):
        by_symbol.setdefault(c, []).append(k)
    for c, at in by_symbol.items():
        mask = 0
        for k in at:
            mask |= 1 << k
        masks[c] = mask
    return masks


def edit_distance(a: Sequence[Hashable], b: Sequence[Hashable], budget: int) -> int | None:
    """Levenshtein distance of ``a`` and ``b`` if it is at most ``budget``, else None.

    The band of column j holds rows j - e to j + e; its vertical differences
    are kept in two integers that move down by one row per column.
    """
    if len(a) < len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if m - n > budget or budget < 0:
        return None
    # Equal ends cost nothing and need no band.
    lo = 0
    while lo < n and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < n - lo and a[m - 1 - hi] == b[n - 1 - hi]:
        hi += 1
    a, b = a[lo: m - hi], b[lo: n - hi]
    m, n = len(a), len(b)
    if n == 0:
        return m
    e = min(budget, m)
    masks, full, top = _places(a), (1 << (2 * e + 1)) - 1, 1 << (2 * e)
    up, down = full & ~((1 << e) - 1), 0
    score, row = e, top >> 1  # score: at row j + e, later at the last row
    for j in range(1, n + 1):
        shift = j - 1 - e
        eq = masks.get(b[j - 1], 0)
        eq = (eq >> shift if shift >= 0 else eq << -shift) & full
        d0 = ((((eq & up) + up) ^ up) | eq | down) & full
        plus, minus = (down | ~(d0 | up)) & full, d0 & up
        if j + e <= m:
            # Along the band's edge diagonal the distance never falls, and the
            # last cell is at most e columns and e rows away from it.
            score += not d0 & top
            if score > budget + 2 * e:
                return None
        else:
            score += (plus & row != 0) - (minus & row != 0)
            row >>= 1
        up, down = (minus | ~((d0 >> 1) | plus)) & full, (d0 >> 1) & plus
    return score if score <= budget else None


def _ends(pattern: Sequence[Hashable], text: Sequence[Hashable], budget: int) -> tuple[int, int] | None:
    """(distance, end) of the best occurrence that ends first; the start is free."""
    m = len(pattern)
    masks, full, top = _places(pattern), (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, None
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        d0 = ((((eq & up) + up) ^ up) | eq | down) & full
        plus, minus = (down | ~(d0 | up)) & full, d0 & up
        score += (plus & top != 0) - (minus & top != 0)
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = (minus | ~(d0 | plus)) & full, d0 & plus
        if score <= budget and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


def find_within(pattern: Sequence[Hashable], text: Sequence[Hashable], budget: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the pattern's best occurrence in ``text``, or None."""
    found = _ends(pattern, text, budget)
    if found is None:
        return None
    distance, end = found
    back = _ends(pattern[::-1], text[:end][::-1], distance)
    return distance, end - (back[1] if back else len(pattern)), end
