"""Exact hypergeometric draws for plans of bounded size.

Counts may be of any size: the draw walks outwards from the mode, about as many steps as the deviation.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def hypergeometric(rng: random.Random, good: int, bad: int, drawn: int) -> int:
    """How many good ones are among ``drawn`` of ``good + bad`` things."""
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))
    weight = math.exp(_log_choose(good, mode) + _log_choose(bad, drawn - mode) - _log_choose(good + bad, drawn))
    left = rng.random() - weight
    up = down = mode
    above = below = weight
    while left > 0 and (up < high or down > low) and above + below > 1e-18:
        if up < high:
            above *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up += 1
            left -= above
            if left <= 0:
                return up
        else:
            above = 0.0
        if down > low:
            below *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down -= 1
            left -= below
            if left <= 0:
                return down
        else:
            below = 0.0
    return mode


def share_out(rng: random.Random, colours: Sequence[int], drawn: int) -> list[int]:
    """A multivariate hypergeometric draw: how many of each colour are among ``drawn`` things."""
    rest, out = sum(colours), []
    for count in colours:
        rest -= count
        out.append(hypergeometric(rng, count, rest, drawn))
        drawn -= out[-1]
    return out


def communication_matrix(rng: random.Random, rows: Sequence[int], columns: Sequence[int]) -> list[list[int]]:
    """Counts per row and column as a uniform shuffle of everything would give them; both margins are exact."""
    left, out = list(columns), []
    for count in rows:
        out.append(share_out(rng, left, count))
        left = [a - b for a, b in zip(left, out[-1])]
    return out


def splitting_tree(rng: random.Random, quotas: Sequence[int], sizes: Sequence[int]) -> list[list[int]]:
    """Quotas per part, by halving the parts again and again; returns one row of quotas per part."""
    if len(sizes) == 1:
        return [list(quotas)]
    half = len(sizes) // 2
    first = share_out(rng, quotas, sum(sizes[:half]))
    rest = [a - b for a, b in zip(quotas, first)]
    return splitting_tree(rng, first, sizes[:half]) + splitting_tree(rng, rest, sizes[half:])
