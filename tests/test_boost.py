import math
import random

import pytest
from pyspark.sql import functions as F

from lathe.operators import boost as B

FEATS = ["a", "b", "c"]


def table(spark, n=400, seed=3, parts=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rnd.randint(0, 12) * 1.0, rnd.choice([None, 0.5, 1.5, 2.5]), rnd.random()
        rows.append((i, a, b, c, 3 * a - 2 * (b or 0) + (5 if c > 0.4 else 0) + rnd.gauss(0, 0.3)))
    rows.append((n, 1.0, 1.0, 0.1, None))  # without a target
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(parts)


def plain_fit(rows, p, scale=2.0 ** 16, quantile=None):
    """Trees grown one split at a time from lists of rows."""
    rows = [r for r in rows if r["y"] is not None]
    ints = lambda g: math.floor(g * scale + 0.5)
    base = sum(ints(r["y"]) for r in rows) / len(rows) / scale
    margin = {r["id"]: base for r in rows}

    def score(g, k):
        s = B.soft(g / scale, p.reg_alpha)
        return s * s / (k + p.reg_lambda)

    def best(ids, feats, grad):
        out = None
        for f in feats:
            name = FEATS[f]
            val = lambda r: -math.inf if r[name] is None else r[name]
            cuts = quantile[f] if quantile and quantile[f] is not None else sorted(
                {r[name] for r in rows if r[name] is not None})[:-1]
            for cut in cuts:
                left = [r for r in ids if val(r) <= cut]
                gl, kl = sum(grad[r["id"]] for r in left), len(left)
                g, k = sum(grad[r["id"]] for r in ids), len(ids)
                if kl < max(p.min_child_rows, 1) or k - kl < max(p.min_child_rows, 1):
                    continue
                gain = score(gl, kl) + score(g - gl, k - kl) - score(g, k)
                if gain > 0 and (out is None or gain > out[0]):
                    out = (gain, f, cut, left, [r for r in ids if val(r) > cut])
        return out

    trees = []
    for t in range(p.n_estimators):
        feats = B.tree_columns(p, len(FEATS), t)
        grad = {r["id"]: ints(margin[r["id"]] - r["y"]) for r in rows}
        tree, open_, splits = {}, {1: rows}, 0
        while True:
            can = {}
            for n, ids in open_.items():
                got = best(ids, feats, grad) if n.bit_length() <= p.depth() else None
                if got:
                    can[n] = got
            if not can or (p.num_leaves and splits == p.num_leaves - 1):
                break
            n = min(can, key=lambda n: (-can[n][0], n)) if p.num_leaves else min(can)
            _, f, cut, left, right = can[n]
            tree[n] = (FEATS[f], cut, None)
            del open_[n]
            open_[2 * n], open_[2 * n + 1], splits = left, right, splits + 1
        for n, ids in open_.items():
            w = -B.soft(sum(grad[r["id"]] for r in ids) / scale, p.reg_alpha) / (len(ids) + p.reg_lambda) * p.learning_rate
            tree[n] = (None, None, w)
            for r in ids:
                margin[r["id"]] += w
        trees.append(tree)
    return base, trees


PARAMS = [
    B.BoostParams(n_estimators=3, max_depth=2, learning_rate=0.3),
    B.BoostParams(n_estimators=2, max_depth=3, learning_rate=0.2, reg_alpha=8.0, reg_lambda=2.5, colsample_bytree=0.7),
    B.BoostParams(n_estimators=3, max_depth=9, learning_rate=0.1, reg_alpha=1.0, reg_lambda=1.5, num_leaves=7, min_child_rows=20),
    B.BoostParams(n_estimators=1, max_depth=-1, num_leaves=40, min_child_rows=1),
]


def small(spark, **kw):
    return table(spark, 120, **kw).withColumn("c", F.round("c", 1))


@pytest.mark.parametrize("k", range(len(PARAMS)))
def test_equals_a_plain_fit(spark, k):
    df, p = small(spark), PARAMS[k]
    base, trees = plain_fit([r.asDict() for r in df.collect()], p)
    got = B.fit_booster(df, FEATS, "y", p)
    assert got.base == base and got.trees == trees


def test_fit_does_not_depend_on_layout_and_shared_passes_change_nothing(spark, monkeypatch):
    one = [B.fit_booster(small(spark, parts=1), FEATS, "y", p) for p in PARAMS[:3]]
    monkeypatch.setattr(B, "REFRESH", 2)
    together = B.fit_boosters(small(spark, parts=7), FEATS, "y", PARAMS[:3])
    assert [(m.base, m.trees) for m in together] == [(m.base, m.trees) for m in one]


def test_column_sums_the_trees_and_survives_the_registry_table(spark):
    df = table(spark)
    m = B.fit_booster(df, FEATS, "y", B.BoostParams(n_estimators=12, max_depth=4, learning_rate=0.3, max_bins=16))

    def value(tree, r):
        n = 1
        while tree[n][0] is not None:
            f, cut, _ = tree[n]
            n = 2 * n + (r[f] is not None and r[f] > cut)
        return tree[n][2]

    again = B.booster_of(B.booster_table(spark, m), FEATS)
    assert (again.base, again.trees) == (m.base, m.trees)
    rows = B.predict_booster(df, again).collect()
    for r in rows:
        assert r.prediction == pytest.approx(m.base + sum(value(t, r) for t in m.trees), abs=1e-9)
    ok = [r for r in rows if r.y is not None]
    mean = sum(r.y for r in ok) / len(ok)
    assert sum((r.y - r.prediction) ** 2 for r in ok) < 0.05 * sum((r.y - mean) ** 2 for r in ok)
    nan = df.limit(1).withColumn("a", F.lit(float("nan")))
    null = df.limit(1).withColumn("a", F.lit(None).cast("double"))
    assert B.predict_booster(nan, m).first().prediction == B.predict_booster(null, m).first().prediction


def test_leaves_depth_and_penalties(spark):
    df = table(spark)
    for leaves in (2, 5, 9):
        m = B.fit_booster(df, FEATS, "y", B.BoostParams(n_estimators=2, max_depth=9, num_leaves=leaves, max_bins=32))
        assert all(sum(v[0] is None for v in t.values()) == leaves for t in m.trees)
    m = B.fit_booster(df, FEATS, "y", B.BoostParams(n_estimators=2, max_depth=3, max_bins=32))
    assert max(n.bit_length() for t in m.trees for n in t) <= 4
    flat = B.fit_booster(df, FEATS, "y", B.BoostParams(n_estimators=1, reg_alpha=1e9, max_bins=32))
    assert flat.trees == [{1: (None, None, 0.0)}] or flat.trees[0][1][2] == 0
    weak, strong = (B.fit_booster(df, FEATS, "y", B.BoostParams(n_estimators=1, max_depth=2, reg_lambda=x, max_bins=32))
                    for x in (0.0, 500.0))
    size = lambda m: max(abs(v[2]) for v in m.trees[0].values() if v[0] is None)
    assert size(strong) < size(weak)


def test_row_sampling_is_by_key_and_tree(spark):
    df = table(spark)
    p = B.BoostParams(n_estimators=2, max_depth=3, subsample=0.5, max_bins=32)
    with pytest.raises(ValueError, match="row_key"):
        B.fit_booster(df, FEATS, "y", p)
    a, b = (B.fit_booster(d, FEATS, "y", p, ["id"]) for d in (df, df.repartition(5)))
    assert a.trees == b.trees and a.trees != B.fit_booster(df, FEATS, "y", B.BoostParams(2, 3, max_bins=32)).trees
    import numpy as np

    keys = np.arange(20_000, dtype=np.int64)
    first, second = B.drawn_rows(keys, 0, 42, 0.5), B.drawn_rows(keys, 1, 42, 0.5)
    assert abs(first.mean() - 0.5) < 0.02 and abs((first & second).mean() - 0.25) < 0.02


def test_cut_points_of_few_and_many_values(spark):
    df = table(spark)
    few, _, many = B.cut_points(df, FEATS, 16)
    assert few == [float(x) for x in range(12)] and len(many) == 15 and many == sorted(many)
    sketch = B.cut_points(df, FEATS, 16, "sketch")[2]
    assert len(sketch) <= 15 and all(abs(a - b) < 0.1 for a, b in zip(many, sketch))
    const = df.withColumn("a", F.lit(1.0))
    assert B.cut_points(const, FEATS, 16)[0] == []
    m = B.fit_booster(const, ["a"], "y", B.BoostParams(n_estimators=1))
    assert m.trees[0][1][0] is None and abs(m.trees[0][1][2]) < 1e-4
    with pytest.raises(ValueError, match="no training rows"):
        B.fit_booster(df.where("y is null"), FEATS, "y")


def test_narrow_rows_are_dealt_to_every_core(spark, monkeypatch):
    """One file of narrow rows was one task of every pass."""
    from lathe.operators import boost

    parts, write = [], boost.materialize

    def seen(df, name):
        parts.append((name, df.rdd.getNumPartitions()))
        return write(df, name)

    monkeypatch.setattr(boost, "materialize", seen)
    monkeypatch.setattr(boost, "TASK_ROWS", (100, 500))
    df = spark.range(3000).coalesce(1).selectExpr("id % 7 AS x", "CAST(id % 5 AS DOUBLE) AS y")
    boost.fit_booster(df, ["x"], "y", boost.BoostParams(n_estimators=1, max_depth=1))
    assert dict(parts)["boost-rows"] == 6
