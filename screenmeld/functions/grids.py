"""Parameter grids: configuration-sized lists of consensus parameters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from screenmeld.catalog import SIGMA_FRACTION, SIGMA_FRACTIONS, WEIGHT_STEP, score


def weight_grid(k: int, step: float = WEIGHT_STEP) -> list[tuple[float, ...]]:
    """All weight tuples on the simplex with the given step, first weight rising slowest."""
    n = round(1.0 / step)
    return [tuple(round(c * step, 4) for c in parts)
            for parts in product(range(n + 1), repeat=k) if sum(parts) == n]


@dataclass(frozen=True)
class GridPoint:
    gid: int
    kind: str  # "grid", or "equal" for the equal weighting
    sigma: int
    weights: tuple[float, ...]

    def text(self, keys: Sequence[str]) -> str:
        return "/".join(f"{score(k).label}={w:.2f}" for k, w in zip(keys, self.weights))


def parameter_grid(keys: Sequence[str], sigmas: Sequence[int] = SIGMA_FRACTIONS,
                   step: float = WEIGHT_STEP) -> list[GridPoint]:
    """Sigma outer, weights inner; equal weightings follow with higher numbers.

    The numbering is the search order: among equal metrics the lowest wins.
    """
    points = [("grid", s, w) for s in sigmas for w in weight_grid(len(keys), step)]
    equal = tuple(round(1.0 / len(keys), 4) for _ in keys)
    points += [("equal", s, equal) for s in sorted({*sigmas, SIGMA_FRACTION})]
    return [GridPoint(i, kind, s, w) for i, (kind, s, w) in enumerate(points)]
