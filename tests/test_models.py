import pytest
from pyspark.sql import functions as F

from lathe.operators import evaluate as ev
from lathe.operators.models import booster_params
from lathe.operators.pipeline import load_pipeline, preset, save_pipeline
from lathe.operators.split import split


@pytest.mark.parametrize("kind", ["xgboost", "lightgbm"])
def test_booster_beats_the_mean_and_survives_the_registry(spark, kind, tmp_path):
    df = spark.range(600).select(
        F.col("id"), (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    df = df.withColumn("y", F.col("a") * 3 + F.col("b") * F.col("b") + (F.col("id") % 3))
    s = split(df, ["id"], 0.2)
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    pipe = preset(kind, ["a", "b"], "y", n_estimators=15, scaler="robust" if kind == "xgboost" else None).fit(train, "id")
    pred = pipe.predict(test, "id")
    r2 = ev.regression_metrics(pred, "y", "prediction").first()["r2"]
    mean = train.agg(F.avg("y")).first()[0]
    base = ev.regression_metrics(test.withColumn("p", F.lit(mean)), "y", "p").first()["r2"]
    assert r2 > 0.6 > base
    save_pipeline(spark, pipe, str(tmp_path), "m", 1)
    again = load_pipeline(spark, str(tmp_path), "models:/m/1").predict(test, "id")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, pred.collect()))
    assert "Python" not in again._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(TypeError):
        booster_params(kind, no_such_parameter=1)


def test_metrics_pipeline_independent_of_partitioning(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    base = E.queries()["metrics_by_group"](spark, sf).collect()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert sorted(E.queries()["metrics_by_group"](spark, sf).collect()) == sorted(base)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_prep_experiments_rejects_unknown_mode(spark):
    from lathe.plans.q_models import prep_experiments

    with pytest.raises(ValueError, match="No such feature mode"):
        prep_experiments(spark, "/root/testdata/sf0.001", ["none", "cubic"])


def test_ridge_equals_the_closed_form(spark):
    import numpy as np

    from lathe.operators.ridge import fit_ridge, ridge_prediction

    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 2))
    y = 3 * x[:, 0] - x[:, 1] + 5
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)], "a double, b double, y double")
    got = fit_ridge(df, {"both": ["a", "b"], "one": ["b"]}, "y", 10.0)
    z = x - x.mean(0)
    w = np.linalg.solve(z.T @ z + 10 * np.eye(2), z.T @ (y - y.mean()))
    assert np.allclose([got["both"]["weights"][c] for c in "ab"], w)
    p = df.select(ridge_prediction(got["both"]).alias("p")).first()["p"]
    assert abs(p - (y.mean() + (x[0] - x.mean(0)) @ w)) < 1e-9
    assert fit_ridge(df.limit(0), {"m": ["a"]}, "y") == {"m": {"intercept": 0.0, "weights": {"a": 0.0}}}


def test_concurrent_saves_get_versions_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from lathe.operators.models import claim_version, list_versions, load_model, save_model

    root = str(tmp_path / "registry")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: claim_version(spark, root, "many"), range(40)))
        paths = list(pool.map(lambda k: save_model(spark, root, "m", None, "kind", ["a"], params={"k": k}), range(4)))
    assert sorted(got) == list(range(1, 41)) and len(set(paths)) == 4
    assert sorted(r.version for r in list_versions(spark, root).collect()) == [1, 2, 3, 4]  # claims alone are not listed
    assert {load_model(spark, root, f"models:/m/{v}")["params"]["k"] for v in range(1, 5)} == {0, 1, 2, 3}
    save_model(spark, root, "m", 9, "kind", ["a"])
    assert save_model(spark, root, "m", None, "kind", ["a"]).endswith("version=10")
    assert load_model(spark, root, "m")["version"] == 10
