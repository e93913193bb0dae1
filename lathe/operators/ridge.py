"""Ridge regression from sufficient statistics.

One grouped aggregate over the training rows gives means and centred
products of every candidate column; the small normal equations are solved on
the driver (their size is the number of columns). Several models over the
same rows (scalers, feature sets) share that one pass. The penalty makes the
fit depend on how columns are scaled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit_ridge(df: DataFrame, models: dict[str, list[str]], target: str, penalty: float = 1.0) -> dict[str, dict]:
    """``{model: {"intercept", "weights": {column: w}}}`` for each named list of
    columns. Rows must have no missing value in the columns used; an empty
    frame predicts 0."""
    cols = sorted({c for cs in models.values() for c in cs})
    means = df.agg(*[F.avg(c).alias(c) for c in [*cols, target]]).first().asDict()
    if means[target] is None:
        return {m: {"intercept": 0.0, "weights": dict.fromkeys(cs, 0.0)} for m, cs in models.items()}
    dev = lambda c: F.col(c) - F.lit(means[c])
    pairs = sorted({(a, b) for cs in models.values() for a in cs for b in [*cs, target] if a <= b or b == target})
    sums = df.agg(*[F.sum(dev(a) * dev(b)).alias(f"s{i}") for i, (a, b) in enumerate(pairs)]).first()
    s = {p: float(sums[f"s{i}"]) for i, p in enumerate(pairs)}
    out = {}
    for name, cs in models.items():
        gram = np.array([[s[min(a, b), max(a, b)] for b in cs] for a in cs]) + penalty * np.eye(len(cs))
        w = np.linalg.solve(gram, np.array([s[a, target] for a in cs]))
        out[name] = {"intercept": means[target] - float(sum(x * means[c] for x, c in zip(w, cs, strict=True))),
                     "weights": dict(zip(cs, map(float, w), strict=True))}
    return out


def ridge_prediction(model: dict) -> Column:
    total = F.lit(model["intercept"])
    for c, w in model["weights"].items():
        total = total + F.col(c) * F.lit(w)
    return total
