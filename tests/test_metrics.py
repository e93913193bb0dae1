import math

import pytest
from pyspark.sql import functions as F

from lathe.functions.columns import MAPE_EPS
from lathe.operators import evaluate as ev


def _metrics(spark, rows, by=()):
    df = spark.createDataFrame(rows, "g string, y double, p double")
    return {r["g"] if by else None: r.asDict() for r in ev.regression_metrics(df, "y", "p", by=list(by)).collect()} \
        if by else ev.regression_metrics(df, "y", "p").first().asDict()


def test_metrics_match_formulas(spark):
    rows = [("a", 1.0, 2.0), ("a", 2.0, 2.0), ("a", 4.0, 3.0), ("a", 8.0, 10.0)]
    m = _metrics(spark, rows)
    ys, ps = [r[1] for r in rows], [r[2] for r in rows]
    e = [p - y for y, p in zip(ys, ps)]
    n = len(ys)
    mean = sum(ys) / n
    sst = sum((y - mean) ** 2 for y in ys)
    assert m["n"] == 4
    assert m["mae"] == pytest.approx(sum(abs(x) for x in e) / n)
    assert m["mse"] == pytest.approx(sum(x * x for x in e) / n)
    assert m["rmse"] == pytest.approx(math.sqrt(m["mse"]))
    assert m["r2"] == pytest.approx(1 - sum(x * x for x in e) / sst)
    assert m["mape"] == pytest.approx(100 * sum(abs(x) / abs(y) for x, y in zip(e, ys)) / n)
    assert m["wmape"] == pytest.approx(100 * sum(abs(x) for x in e) / sum(abs(y) for y in ys))
    assert m["rmse"] >= m["mae"]


def test_zero_targets(spark):
    # some y = 0: MAPE uses the epsilon floor
    m = _metrics(spark, [("a", 0.0, 1.0), ("a", 2.0, 2.0)])
    assert m["mape"] == pytest.approx(100 * (1.0 / MAPE_EPS) / 2)
    # all y = 0: WMAPE is NULL, constant target: R² rule (SSE>0 → 0)
    m = _metrics(spark, [("a", 0.0, 1.0), ("a", 0.0, 0.0)])
    assert m["wmape"] is None
    assert m["r2"] == 0.0
    m = _metrics(spark, [("a", 3.0, 3.0), ("a", 3.0, 3.0)])
    assert m["r2"] == 1.0


def test_grouped_metrics(spark):
    out = _metrics(spark, [("a", 1.0, 1.0), ("a", 2.0, 3.0), ("b", 5.0, 5.0)], by=["g"])
    assert out["a"]["n"] == 2 and out["b"]["n"] == 1
    assert out["b"]["mae"] == 0.0


def _split_metrics(spark, train, test):
    rows = [("train", *train), ("test", *test)]
    return spark.createDataFrame(rows,
                                 "split string, mae double, mse double, rmse double, r2 double, mape double, wmape double")


def test_overfitting_guards(spark):
    m = _split_metrics(spark, (0.0, 0.0, 0.0, 0.9, 0.0, 0.0), (2.0, 4.0, 2.0, -0.1, 5.0, 6.0))
    o = ev.overfitting(m).first()
    assert o["overfitting_ratio_mae"] is None  # train mae = 0 → omitted
    assert o["overfitting_ratio_r2"] is None  # test r2 <= 0 → omitted
    assert o["r2_gap"] == pytest.approx(1.0) and o["overfitting_r2_diff"] == pytest.approx(1.0)
    z = ev.overfitting(m, on_zero="zero").first()
    assert z["overfitting_ratio_mape"] == 0.0 and z["overfitting_ratio_r2"] == pytest.approx(0.9 / -0.1)
    # missing ratio counts as 1.0 → "Minimal", the NULL stays visible
    s = ev.performance_summary(ev.overfitting(m)).first()
    assert s["overfitting_level"] == "Minimal" and s["overfitting_ratio"] == 1.0
    assert s["performance_level"] == "Very Poor" and s["performance_score"] == 1.0


@pytest.mark.parametrize("r2,level", [(0.95, "Excellent"), (0.9, "Excellent"), (0.85, "Good"), (0.7, "Fair"),
                                      (0.5, "Poor"), (0.49, "Very Poor")])
def test_tiers(spark, r2, level):
    m = _split_metrics(spark, (1.0, 1.0, 1.0, r2, 1.0, 1.0), (1.0, 1.0, 1.0, r2, 1.0, 1.0))
    assert ev.performance_summary(ev.overfitting(m)).first()["performance_level"] == level


def test_cv_statistics_population_std_and_sign(spark):
    rows = [(f, "test_neg_mean_absolute_error", -v) for f, v in enumerate([1.0, 2.0, 3.0])]
    rows += [(f, "test_r2", v) for f, v in enumerate([0.5, 0.7, 0.6])]
    st = {r["metric"]: r for r in ev.cv_statistics(
        spark.createDataFrame(rows, "fold int, metric string, score double")).collect()}
    mae = st["test_mean_absolute_error"]
    assert mae["mean"] == pytest.approx(2.0)
    assert mae["std"] == pytest.approx(math.sqrt(2 / 3))  # population std
    assert mae["scores"] == [1.0, 2.0, 3.0]
    assert st["test_r2"]["scores"] == [0.5, 0.7, 0.6]


def test_format_metric(spark):
    df = spark.createDataFrame([("test_mae", 1234.5), ("r2", 0.12345), ("wmape", 12.345), ("mae_gap", -3.0),
                                ("overfitting_ratio_r2", 1.23456), ("mape_gap", 1.5)], "name string, v double")
    got = {r["name"]: r["d"] for r in df.select("name", ev.format_metric(F.col("name"), F.col("v")).alias("d")).collect()}
    assert got == {"test_mae": "$1,234.50", "r2": "0.1235", "wmape": "12.35%", "mae_gap": "$-3.00",
                   "overfitting_ratio_r2": "1.2346", "mape_gap": "1.50%"}
