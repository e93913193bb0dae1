import math

import pytest
from pyspark.sql import functions as F

from lathe.operators import features as FE
from lathe.operators.outliers import iqr_bounds, remove_outliers
from lathe.operators.quantiles import quantiles
from lathe.operators.split import kfold, split


@pytest.mark.parametrize("n", [1, 4, 7, 101])
@pytest.mark.parametrize("ts", [0.2, 0.25, 0.3])
def test_split_exact_sizes(spark, n, ts):
    df = spark.range(n).withColumnRenamed("id", "k")
    s = split(df, ["k"], ts, 42).groupBy("split").count().collect()
    got = {r["split"]: r["count"] for r in s}
    n_test = math.ceil(ts * n)
    assert got.get("test", 0) == n_test and got.get("train", 0) == n - n_test


@pytest.mark.parametrize("n", [4, 7, 101])
def test_kfold_sizes_differ_by_one(spark, n):
    k = 5 if n >= 5 else 2
    sizes = sorted(r["count"] for r in kfold(spark.range(n).withColumnRenamed("id", "k"), ["k"], k).groupBy(
        "fold").count().collect())
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_split_independent_of_partitioning(spark):
    base = spark.range(500).withColumnRenamed("id", "k")
    a = {r["k"]: r["split"] for r in split(base.repartition(1), ["k"]).collect()}
    b = {r["k"]: r["split"] for r in split(base.repartition(7), ["k"]).collect()}
    c = {r["k"]: r["split"] for r in split(base.repartition(64), ["k"]).collect()}
    assert a == b == c
    assert len(a) == 500


def test_constant_feature_scalers_and_fscore(spark):
    df = spark.createDataFrame([(i, 5.0, float(i)) for i in range(10)], "id int, x double, y double")
    for kind in ("robust", "standard", "minmax"):
        p = FE.fit_scaler(df, ["x"], kind)
        assert p["scale"]["x"] == 1.0
    out = FE.apply_scaler(df, FE.fit_scaler(df, ["x"], "minmax")).select("x").distinct().collect()
    assert [r["x"] for r in out] == [0.0]  # range minimum, not 0.5
    scores = {r["feature"]: r["f_score"] for r in FE.f_scores(df, ["x", "y"], "y").collect()}
    assert scores["x"] == 0.0 and scores["y"] == FE.FLOAT64_MAX


def test_robust_scaler_exact_quantiles(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    p = FE.fit_scaler(df, ["x"], "robust")
    assert p["center"]["x"] == 3.0 and p["scale"]["x"] == 2.0  # q75 4 − q25 2


def test_log_semantics(spark):
    df = spark.createDataFrame([(-2.0,), (-1.0,), (0.0,), (3.0,)], "x double")
    got = [r["x"] for r in FE.log_replace(df, ["x", "nope"]).collect()]
    assert math.isnan(got[0]) and got[1] == float("-inf") and got[2] == 0.0 and got[3] == pytest.approx(math.log1p(3))
    pos = spark.createDataFrame([(1.0, 0.0, None), (2.0, 1.0, 1.0)], "a double, b double, c double")
    assert FE.fit_log_append(pos, ["a", "b", "c"]) == ["a"]


def test_poly_names_and_values(spark):
    terms = [n for n, _ in FE.poly_terms(["a", "b", "c"], 2, True, False)]
    assert terms == ["a", "b", "c", "a b", "a c", "b c"]
    full = [n for n, _ in FE.poly_terms(["a", "b"], 2, False, True)]
    assert full == ["1", "a", "b", "a^2", "a b", "b^2"]
    assert len(FE.poly_terms([f"x{i}" for i in range(33)], 2, True, False)) == 561
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    r = FE.polynomial(df, ["a", "b"], 2, False, True).first()
    assert r["a b"] == 6.0 and r["a^2"] == 4.0 and r["1"] == 1.0


def test_select_k_best_ties_to_later_column(spark):
    df = spark.createDataFrame([(float(i), float(i), float(i % 3), float(i)) for i in range(20)],
                               "a double, b double, c double, y double")
    assert FE.select_k_best(df, ["a", "b", "c"], "y", 1) == ["b"]
    assert FE.select_k_best(df, ["a", "b", "c"], "y", 50) == ["a", "b", "c"]


def test_iqr_inclusive_and_null_target(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]] + [(None,)], "y double")
    lo, hi = iqr_bounds(df, "y", 1.5)
    assert (lo, hi) == (-3.0, 13.0)  # Q1 = 3, Q3 = 7 (linear interpolation)
    kept = [r["y"] for r in remove_outliers(df, "y").collect()]
    assert 100.0 not in kept and None not in kept and len(kept) == 8
    # idempotent under fixed bounds
    again = remove_outliers(remove_outliers(df, "y"), "y", fit_on=df).count()
    assert again == 8
    assert remove_outliers(df, "y", method="zscore").count() == df.count()  # unknown method: no-op


def test_bucketed_quantiles_equal_exact(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 1013 / 7.0).alias("v"))
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    exact = quantiles(df, ["v"], qs, "percentile")["v"]
    bucketed = quantiles(df, ["v"], qs, "exact", buckets=32)["v"]
    assert bucketed == pytest.approx(exact, abs=1e-12)
    hot = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(5.0)).otherwise(F.col("id") * 1.0).alias("v"))
    assert quantiles(hot, ["v"], qs, "exact", buckets=16)["v"] == pytest.approx(
        quantiles(hot, ["v"], qs, "percentile")["v"])


def test_approx_quantiles_close(spark):
    df = spark.range(10000).select((F.col("id") * 1.0).alias("v"))
    approx = quantiles(df, ["v"], [0.25, 0.5], "approx")["v"]
    exact = quantiles(df, ["v"], [0.25, 0.5], "percentile")["v"]
    assert approx == pytest.approx(exact, rel=0.01)


def test_grouped_quantiles_equal_percentile(spark):
    from lathe.operators.quantiles import grouped_quantiles

    df = spark.range(3000).select((F.col("id") % 4).alias("g"),
                                  F.when(F.col("id") < 1000, F.lit(7.0)).otherwise(F.col("id") * 0.37 % 53).alias("v"))
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(5)] for r in grouped_quantiles(df, ["g"], "v", qs).collect()}
    exp = {r["g"]: r["p"] for r in df.groupBy("g").agg(F.percentile("v", qs).alias("p")).collect()}
    for g in exp:
        assert got[g] == pytest.approx(exp[g], abs=1e-9)


def test_grouped_quantiles_hot_group_small_buckets(spark):
    from lathe.operators.quantiles import grouped_quantiles

    # one group holds most rows, many distinct values; few buckets force multi-bucket lookups
    df = spark.range(6000).select(F.when(F.col("id") < 4000, F.lit(0)).otherwise(F.col("id") % 3 + 1).alias("g"),
                                  (F.col("id") * 0.731 % 997).alias("v"))
    qs = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(5)] for r in grouped_quantiles(df, ["g"], "v", qs, buckets=8).collect()}
    exp = {r["g"]: r["p"] for r in df.groupBy("g").agg(F.percentile("v", qs).alias("p")).collect()}
    for g in exp:
        assert got[g] == pytest.approx(exp[g], abs=1e-9)


def test_split_labels_equal_the_full_ranking_and_move_no_rows(spark):
    from lathe.operators.split import RANK, exact_rank, fold_of

    df = spark.range(1, 778).withColumnRenamed("id", "k").withColumn("x", F.col("k") * 2)
    ranked, _ = exact_rank(df, ["k"], 42)
    want = {r["k"]: (r[RANK] <= math.ceil(0.2 * 777), r["fold"]) for r in ranked.withColumn(
        "fold", fold_of(F.col(RANK) - 1, F.col("_total"), 5)).collect()}
    got, folds = split(df, ["k"], 0.2, 42), kfold(df, ["k"], 5, 42)
    assert {r["k"]: r["split"] == "test" for r in got.collect()} == {k: v[0] for k, v in want.items()}
    assert {r["k"]: r["fold"] for r in folds.collect()} == {k: v[1] for k, v in want.items()}
    for plan in (got, folds):
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_split_sizes_hold_where_ids_repeat(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(100)], "k int, x int")
    got = {r["split"]: r["count"] for r in split(df, ["k"], 0.25).groupBy("split").count().collect()}
    assert got == {"test": 25, "train": 75}
    folds = sorted(r["count"] for r in kfold(df, ["k"], 4).groupBy("fold").count().collect())
    assert folds == [25, 25, 25, 25]
    assert split(df.limit(0), ["k"], 0.2).count() == 0 and kfold(df.limit(0), ["k"], 3).count() == 0


def test_grouped_quantiles_null_keys_missing_values_and_one_group(spark):
    from lathe.operators.quantiles import grouped_quantiles

    rows = [(None, "a", float(i)) for i in range(11)] + [("x", None, None), ("x", None, float("nan")), ("y", None, 4.0)]
    df = spark.createDataFrame(rows, "g string, h string, v double")
    got = {(r.g, r.h): (r.q0, r.q1) for r in grouped_quantiles(df, ["g", "h"], "v", [0.25, 1.0], buckets=5).collect()}
    assert got == {(None, "a"): (2.5, 10.0), ("y", None): (4.0, 4.0)}
    assert grouped_quantiles(df.limit(0), ["g"], "v", [0.5]).count() == 0


def test_prediction_summary_scans_the_log_twice(spark, monkeypatch):
    from lathe.operators import compare, quantiles

    log = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.when(F.col("event_id") % 5 > 0, F.col("event_type")).alias("endpoint"), F.col("value").alias("predicted_price"),
        F.col("value").alias("processing_time_ms"))
    plans, plain = [], quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df, name: plans.append(df) or plain(df, name))
    got = compare.prediction_summary(log)
    plans.append(got)
    assert sum(p._jdf.queryExecution().executedPlan().toString().count("events.parquet") for p in plans) == 2
    want = log.groupBy("endpoint").agg(F.percentile("predicted_price", 0.5).alias("m"))
    assert {r.endpoint: r.median_price for r in got.collect()} == pytest.approx({r.endpoint: r.m for r in want.collect()})


def test_polynomial_array_equals_the_columns_and_holds_33_features(spark):
    cols = [f"c{i}" for i in range(33)]
    rows = [tuple(float((7 * r + 3 * i) % 11) / 4 for i in range(33)) for r in range(20)]
    rows += [(None, float("nan"), *[1.0] * 31)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(1)
    wide = FE.polynomial(df, cols, as_array="x")
    got, terms = [r.x for r in wide.collect()], FE.poly_terms(cols)
    assert all(len(x) == 561 == len(terms) for x in got)
    at = {c: i for i, c in enumerate(cols)}
    for x, row in zip(got, df.collect(), strict=True):
        for v, (_, combo) in zip(x, terms, strict=True):
            factors = [row[at[c]] for c in combo]
            assert v is None if None in factors else (math.isnan(v) if any(map(math.isnan, factors)) else v == math.prod(factors))
    for inter, bias in ((True, False), (False, True)):
        some = df.limit(20).where("c0 is not null").select(*cols[:4]).sort(*cols[:4])
        flat = [list(r) for r in FE.polynomial(some, cols[:4], 3, inter, bias).collect()]
        assert flat == [r.x for r in FE.polynomial(some, cols[:4], 3, inter, bias, as_array="x").collect()]
