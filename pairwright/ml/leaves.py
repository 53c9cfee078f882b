"""Factor rows cut into leaves of near neighbours, so that a bound on a leaf can spare the products with its rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LEAF_ROWS = 256


def leaf_cutter(leaf_rows: int = LEAF_ROWS) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """A function from rows to (order, starts): leaf n holds the rows ``order[starts[n] : starts[n + 1]]``.

    Rows are halved along their widest coordinate until a part is no larger than a leaf. Any cut is right, as bounds are taken
    from the rows that a leaf holds. The function goes to the workers by value, so they need not have this package.
    """

    def cut(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order, starts, parts = np.arange(len(rows)), [], [(0, len(rows))]
        while parts:
            first, end = parts.pop()
            if end - first <= leaf_rows:
                starts.append(first)
                continue
            index, half = order[first:end], (end - first) // 2
            part = rows[index]
            widest = np.argmax(part.max(axis=0) - part.min(axis=0))
            order[first:end] = index[np.argpartition(part[:, widest], half)]
            parts += [(first, first + half), (first + half, end)]
        return order, np.array([*sorted(starts), len(rows)])

    return cut
