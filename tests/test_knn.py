import math
import random

import pytest
from pyspark.sql import functions as F

from lathe.operators import knn
from lathe.operators.knn import knn_join, knn_regress


def brute(qs, ps, k, p=2, excl=None):
    out = {}
    for qid, qv, qx in qs:
        cand = []
        for pid, pv, px in ps:
            if excl and qx == px:
                continue
            if p == 2:
                d = sum((a - b) * (a - b) for a, b in zip(qv, pv))
                dist = math.sqrt(d)
            else:
                d = sum(abs(a - b) for a, b in zip(qv, pv))
                dist = d
            cand.append((d, pid, dist))
        cand.sort()
        out[qid] = [(pid, dist) for _, pid, dist in cand[:k]]
    return out


def run(spark, qs, ps, k, p=2, excl=False, **kw):
    feats = ["x", "y"]
    qdf = spark.createDataFrame([(i, *v, x) for i, v, x in qs], "qid long, x double, y double, g int")
    pdf = spark.createDataFrame([(i, *v, x) for i, v, x in ps], "pid long, x double, y double, g int")
    res = knn_join(qdf, pdf, feats, k=k, p=p, qid="qid", pid="pid", exclude=("g", "g") if excl else None, **kw)
    got = {}
    for r in res.orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append((r["pid"], r["distance"]))
    return got


def _check(got, exp):
    assert set(got) == set(exp)
    for q in exp:
        assert [p for p, _ in got[q]] == [p for p, _ in exp[q]], q
        assert [d for _, d in got[q]] == pytest.approx([d for _, d in exp[q]])


def test_ties_and_duplicates(spark):
    # equal distances and duplicate points: ties go to the smaller id
    ps = [(i, (0.0, 0.0), 0) for i in range(10)] + [(100 + i, (1.0, 0.0), 0) for i in range(5)] \
        + [(200, (0.0, 1.0), 0), (201, (-1.0, 0.0), 0)]
    qs = [(1, (0.0, 0.0), 0), (2, (0.5, 0.0), 0), (3, (0.0, 0.5), 0)]
    for k in (1, 3, 5, 12):
        _check(run(spark, qs, ps, k), brute(qs, ps, k))


@pytest.mark.parametrize("p", [1, 2])
def test_random_vs_brute_force_with_hot_vector_and_far_queries(spark, p):
    rnd = random.Random(7)
    ps = [(i, (rnd.randint(0, 30) * 1.0, rnd.gauss(0, 5)), rnd.randint(0, 2)) for i in range(300)]
    ps += [(1000 + i, (3.0, 3.0), i % 3) for i in range(150)]  # a third of the rows on one vector
    qs = [(i, (rnd.uniform(-5, 35), rnd.gauss(0, 6)), rnd.randint(0, 2)) for i in range(60)]
    qs += [(500, (3.0, 3.0), 0), (501, (3.0, 3.0), 1), (502, (500.0, -400.0), 0), (503, (-1e4, 1e4), 2)]
    _check(run(spark, qs, ps, 5, p), brute(qs, ps, 5, p))
    _check(run(spark, qs, ps, 7, p, excl=True), brute(qs, ps, 7, p, excl=True))


def test_fewer_points_than_k(spark):
    ps = [(1, (0.0, 0.0), 0), (2, (5.0, 5.0), 0)]
    qs = [(1, (1.0, 1.0), 0)]
    _check(run(spark, qs, ps, 5), brute(qs, ps, 5))


@pytest.mark.parametrize("leaf", [1, 2, 7])
def test_deep_pyramids_stay_exact(spark, monkeypatch, leaf):
    monkeypatch.setattr(knn, "FANOUT", 3)
    rnd = random.Random(3)
    ps = [(i, (rnd.random() * 100, rnd.random() * 100), i % 3) for i in range(200)]
    qs = [(i, (rnd.random() * 100, rnd.random() * 100), i % 3) for i in range(20)]
    _check(run(spark, qs, ps, 4, leaf=leaf), brute(qs, ps, 4))
    _check(run(spark, qs, ps, 4, excl=True, leaf=leaf), brute(qs, ps, 4, excl=True))


def test_excluded_value_alone_in_a_region(spark):
    # values lie apart: each leaf has one value, and a query's own region is excluded
    ps = [(i, (10.0 * (i % 3) + i * 1e-4, 0.0), i % 3) for i in range(600)] + [(900 + i, (50.0, 50.0), None) for i in range(3)]
    qs = [(v, (10.0 * v, 0.0), v) for v in range(3)] + [(7, (50.0, 50.0), None), (8, (0.0, 0.0), 99)]
    _check(run(spark, qs, ps, 4, excl=True, leaf=8), brute(qs, ps, 4, excl=True))
    same = [(i, (float(i), 0.0), 1) for i in range(50)]
    assert run(spark, [(1, (0.0, 0.0), 1)], same, 4, excl=True) == {}


def test_curve_scaling_is_monotone_and_bounded(spark):
    cuts = [-1e300, -5.0, 0.0, 1e-9, 2.0, 7.0, 1e308]
    xs = sorted([-1e308, *cuts, -3.0, 0.5e-9, 1.0, 100.0, 1.7e308])
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(knn._scaled("x", cuts)).collect()]
    assert got == sorted(got) and 0 <= got[0] and got[-1] < 1 << knn.BITS
    one = spark.range(4).selectExpr("3L AS a", "id AS b").select(knn._curve(["a", "b"])).collect()
    assert [r[0] for r in one] == [0b0101, 0b0111, 0b1101, 0b1111]


def test_distance_weights_zero_distance(spark):
    nb = spark.createDataFrame([(1, 0.0, 10.0), (1, 0.0, 20.0), (1, 2.0, 100.0), (2, 1.0, 10.0), (2, 2.0, 40.0)],
                               "qid int, distance double, y double")
    got = {r["qid"]: r["prediction"] for r in knn_regress(nb, "qid", "y", "distance").collect()}
    assert got[1] == 15.0  # only the zero-distance neighbours, equally
    assert got[2] == pytest.approx((10 / 1 + 40 / 2) / (1 / 1 + 1 / 2))
    uni = {r["qid"]: r["prediction"] for r in knn_regress(nb, "qid", "y", "uniform").collect()}
    assert uni[1] == pytest.approx(130 / 3)


def test_candidates_of_far_dense_and_sparse_queries_are_bounded(spark):
    rnd = random.Random(5)
    ps = [(i, (50 + rnd.random() * 1e-6, 50 + rnd.random() * 1e-6), 0) for i in range(3000)]  # dense
    ps += [(10_000 + i, (rnd.random() * 100, rnd.random() * 100), 0) for i in range(3000)]
    ps += [(20_000 + i, (1.0, 1.0), 0) for i in range(3000)]  # a third on one vector
    qs = [(i, (50 + rnd.random() * 1e-6, 50 + rnd.random() * 1e-6), 0) for i in range(20)]
    qs += [(100 + i, (rnd.random() * 100, rnd.random() * 100), 0) for i in range(20)]
    qs += [(200, (1.0, 1.0), 0), (201, (1e7, -1e7), 0), (202, (-500.0, 90.0), 0), (203, (50.0, 1e9), 0)]
    schema = "id long, x double, y double, g int"
    q, p = (spark.createDataFrame([(i, *v, g) for i, v, g in rows], schema) for rows in (qs, ps))
    _, pairs = knn.knn_candidates(q, p, ["x", "y"], 5, pid="id", leaf=32)
    met = [r["count"] for r in pairs.groupBy("_vid").count().collect()]
    assert len(met) == len(qs) and max(met) <= 12 * 32  # a dozen leaves of 6,001 different vectors
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    _check(run(spark, qs, ps, 5, leaf=32), brute(qs, ps, 5))


def test_dense_cluster_beside_a_sparse_spread_stays_exact(spark):
    rnd = random.Random(11)
    # 400 distinct points packed in a tiny square next to a sparse spread
    ps = [(i, (50 + rnd.random() * 1e-3, 50 + rnd.random() * 1e-3), 0) for i in range(400)]
    ps += [(1000 + i, (rnd.random() * 100, rnd.random() * 100), 0) for i in range(100)]
    qs = [(i, (50 + rnd.random() * 1e-3, 50 + rnd.random() * 1e-3), 0) for i in range(10)]
    qs += [(100 + i, (rnd.random() * 100, rnd.random() * 100), 0) for i in range(10)]
    _check(run(spark, qs, ps, 3, leaf=20), brute(qs, ps, 3))
