"""Hyper-parameter grids. The grid itself is a tiny driver-side list; the
Spark work is evaluating it (``knn_grid_eval`` scores a whole (k, weights)
grid from one neighbour join)."""

from __future__ import annotations

import itertools
import random

# The KNN search space.
KNN_SPACE = {"n_neighbors": [3, 5, 7, 10, 15], "weights": ["uniform", "distance"],
             "algorithm": ["auto", "ball_tree", "kd_tree"], "leaf_size": [20, 30, 40], "p": [1, 2]}


def param_grid(space: dict, max_combinations: int | None = None, seed: int = 42) -> list[dict]:
    """Cartesian grid of ``space`` in key order, whole unless
    ``max_combinations`` is given; when larger than that, a seeded sample without replacement of that size
    (kept in grid order)."""
    keys = list(space)
    combos = [dict(zip(keys, vals)) for vals in itertools.product(*(space[k] for k in keys))]
    if max_combinations is None or len(combos) <= max_combinations:
        return combos
    picked = sorted(random.Random(seed).sample(range(len(combos)), max_combinations))
    return [combos[i] for i in picked]


def grid_size(space: dict) -> int:
    n = 1
    for v in space.values():
        n *= len(v)
    return n
