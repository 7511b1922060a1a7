"""Fitting on a bounded sample: a minimiser, and sparse rows of hashed features."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

import numpy as np


class Rows:
    """Sparse rows, each a list of columns, with a value per entry or 1."""

    def __init__(self, rows: list[np.ndarray], values: list[np.ndarray] | None = None) -> None:
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.columns = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
        self.values = np.concatenate(values) if values else None
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), self.sizes)

    def _weighed(self, each: np.ndarray) -> np.ndarray:
        return each if self.values is None else each * self.values

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self._weighed(weights[self.columns]), len(self.sizes))

    def transposed_times(self, per_row: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, self._weighed(per_row[self.row]), width)


def minimise(
    loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int, memory: int = 8
) -> np.ndarray:
    """Limited-memory BFGS with a halving line search; ``loss`` gives value and gradient."""
    x = start
    value, slope = loss(x)
    pairs: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=memory)
    for _ in range(steps):
        q, alphas = slope.copy(), []
        for s, y in reversed(pairs):
            alphas.append((s @ q) / (y @ s))
            q -= alphas[-1] * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.abs(q).max())
        for (s, y), a in zip(pairs, reversed(alphas), strict=True):
            q += s * (a - (y @ q) / (y @ s))
        descent, step = slope @ q, 1.0
        while step > 1e-10:
            new = x - step * q
            new_value, new_slope = loss(new)
            if new_value <= value - 1e-4 * step * descent:
                break
            step /= 2
        else:
            return x
        s, y = new - x, new_slope - slope
        if s @ y > 1e-12:
            pairs.append((s, y))
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        x, value, slope = new, new_value, new_slope
        if done:
            break
    return x
