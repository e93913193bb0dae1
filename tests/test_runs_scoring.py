import datetime as dt

import pytest
from pyspark.sql import functions as F

from lathe.operators import compare as C
from lathe.operators import runs as R
from lathe.operators import scoring as SC
from lathe.operators import validate as V
from lathe.operators.models import fit_group_mean, parse_model_uri, predict_group_mean
from lathe.operators.pipeline import RegressionPipeline, load_pipeline, save_pipeline
from lathe.session import new_path


def _wide(spark, rows):
    runs = spark.createDataFrame(
        [(rid, "e", rid, "m", st, dt.datetime(2024, 1, 1, 0, i), None) for i, (rid, st, _) in enumerate(rows)],
        R.RUNS_SCHEMA)
    vals = spark.createDataFrame([(rid, "metric", "test_r2", v, None) for rid, _, v in rows if v != "absent"]
                                 + [(rid, "tag", "model_type", None, "m") for rid, _, _ in rows]
                                 + [(rid, "tag", "mlflow.runName", None, rid) for rid, _, _ in rows], R.VALUES_SCHEMA)
    return R.runs_wide(runs, vals, ["test_r2"])


def test_best_run_skips_nan_and_first_wins(spark):
    w = _wide(spark, [("r1", "FINISHED", float("nan")), ("r2", "FINISHED", 0.7), ("r3", "FINISHED", 0.7),
                      ("r4", "FAILED", "absent")])
    best = R.best_run(w, "test_r2").first()
    assert best["run_id"] == "r2" and best["metric_value"] == 0.7
    assert R.best_run(w, "no_such_metric").count() == 0
    order = [r["run_id"] for r in R.ordered(w, "test_r2").orderBy("position").collect()]
    assert order[-1] == "r4"  # NULLs last
    cmp = R.compare_runs(w)
    assert "test_r2" in cmp.columns and "mlflow.runName" in cmp.columns and "test_mae" not in cmp.columns


def test_sweep_isolates_failures(spark):
    df = spark.createDataFrame([("train" if i % 5 else "test", float(i), float(i % 3)) for i in range(50)],
                               "split string, y double, k double")

    def good(s):
        return predict_group_mean(s, fit_group_mean(s.filter("split = 'train'"), "k", "y"), "k")

    def bad(s):
        raise ValueError("boom")

    runs, vals = R.sweep(spark, df, [{"run_name": "g", "model_type": "group_mean", "score": good},
                                     {"run_name": "b", "model_type": "x", "score": bad}], "y", "exp",
                         dt.datetime(2024, 1, 1))
    st = {r["run_name"]: (r["status"], r["error"]) for r in runs.collect()}
    assert st["g"] == ("FINISHED", None) and st["b"][0] == "FAILED" and "boom" in st["b"][1]
    w = R.runs_wide(runs, vals)
    assert w.filter("run_name = 'g'").first()["metrics.test_r2"] is not None


def test_group_mean_fallback(spark):
    tr = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "k string, y double")
    te = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    got = [r["prediction"] for r in predict_group_mean(te, fit_group_mean(tr, "k", "y"), "k").orderBy("k").collect()]
    assert sorted(got) == sorted([2.0, 14.0 / 3, 14.0 / 3])


def test_scoring_codes_and_full_equals_minimal(spark):
    fields = ["bedrooms", "bathrooms", "sqft_living", "sqft_lot", "floors", "sqft_above", "sqft_basement", "zipcode"]
    rows = [(1, 3.0, 2.0, 2000.0, 5000.0, 1.0, 2000.0, 0.0, "98001"),
            (2, 3.0, 2.0, 2000.0, 5000.0, 9.0, 2000.0, 0.0, "98001"),   # floors out of range
            (3, 3.0, 2.0, 2000.0, 5000.0, 2.0, 2000.0, 0.0, "99999"),   # unknown key
            (4, 3.0, 2.0, 2000.0, 5000.0, 2.0, 2000.0, 0.0, "98002")]   # lookup value NaN → invalid feature
    req = spark.createDataFrame(rows, "id int, " + ", ".join(f"{f} double" if f != "zipcode" else "zipcode string"
                                                               for f in fields))
    lookup = spark.createDataFrame([("98001", 1.0), ("98002", float("nan"))], "zipcode string, zip_x double")
    predict = lambda d: d.withColumn("prediction", F.col("sqft_living") * 100 + F.col("zip_x"))
    feats = SC.CORE_FEATURES + ["zip_x"]
    out = SC.score(req, lookup, "zipcode", predict, feats, V.minimal_request_rules(), ["id"], "1", "t")
    codes = {r["id"]: r["error_code"] for r in out.collect()}
    assert codes == {1: None, 2: "VALIDATION_ERROR", 3: "DEMOGRAPHIC_DATA_ERROR", 4: "PREDICTION_ERROR"}
    ok, bad = SC.split_outcome(out)
    assert ok.count() == 1 and bad.count() == 3
    assert {r["error_code"]: r["n"] for r in SC.error_breakdown(out).collect()}["OK"] == 1
    mini = SC.score(SC.minimal_projection(req, ["id"]), lookup, "zipcode", predict, feats,
                    V.minimal_request_rules(), ["id"], "1", "t", prediction_type="minimal")
    assert mini.filter("id = 1").first()["prediction"] == out.filter("id = 1").first()["prediction"]
    with pytest.raises(ValueError, match="Missing required features"):
        SC.score(req, lookup, "zipcode", predict, feats + ["nope"], [], ["id"], "1", "t")


def test_pairs_and_agreement(spark):
    a = spark.createDataFrame([(1, 100.0), (2, 100.0), (3, 0.0), (4, 100.0), (5, 100.0)], "id int, a double")
    b = spark.createDataFrame([(1, 95.0), (2, 85.0), (3, 7.0), (4, None), (6, 1.0)], "id int, b double")
    pairs = C.pair_predictions(a, b, "id", "a", "b")
    got = {r["id"]: r["pct"] for r in pairs.collect()}
    assert got == {1: 5.0, 2: 15.0, 3: 0.0}  # failed side dropped; a = 0 → 0
    ag = C.agreement(pairs).first()
    assert (ag["high"], ag["medium"], ag["low"]) == (1, 1, 1)  # exactly 5 % → medium, 15 % → low
    one = C.agreement(pairs.filter("id = 1")).first()
    assert one["assessment"] == "Insufficient data"


def test_model_save_load_latest(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 5), float(i)) for i in range(60)],
                               "id int, a double, b double, y double")
    root = new_path(spark, "reg-test")
    p1 = RegressionPipeline(["a", "b"], "y", "robust", None, "knn", {"n_neighbors": 3}).fit(df, "id")
    save_pipeline(spark, p1, root, "m", 1)
    p2 = RegressionPipeline(["a", "b"], "y", "standard", None, "knn", {"n_neighbors": 3}).fit(df, "id")
    save_pipeline(spark, p2, root, "m", 2)
    latest = load_pipeline(spark, root, "models:/m/latest")
    assert latest.scaler_params["kind"] == "standard"
    before = {r["id"]: r["prediction"] for r in p1.predict(df, "id").collect()}
    after = {r["id"]: r["prediction"] for r in load_pipeline(spark, root, "m", 1).predict(df, "id").collect()}
    assert before == after
    assert parse_model_uri("models:/house/3") == ("house", "3")
    with pytest.raises(ValueError):
        parse_model_uri("models:/onlyname")


def test_log_records_layout_and_defaults(spark):
    from lathe.sources.sinks import LOG_COLUMNS, to_log_records

    scored = spark.createDataFrame([(1, "98001", 3.7, 2.5, 123.0, "1.0.0")],
                                   "rid int, zipcode string, bedrooms double, bathrooms double, prediction double, "
                                   "model_version string")
    rec = to_log_records(scored, "/v1/predict", "rid")
    assert rec.columns == ["id"] + [n for n, _ in LOG_COLUMNS] and len(LOG_COLUMNS) == 26
    r = rec.first()
    assert r["bedrooms"] == 3 and r["sqft_lot"] is None and r["prediction_type"] == "full"
    assert r["predicted_price"] == 123.0 and r["endpoint"] == "/v1/predict" and r["ts"] is not None


def test_runs_store_is_idempotent(spark):
    runs = spark.createDataFrame([("e-000", "e", "a", "m", "FINISHED", dt.datetime(2024, 1, 1), None)], R.RUNS_SCHEMA)
    vals = spark.createDataFrame([("e-000", "metric", "test_r2", 0.5, None)], R.VALUES_SCHEMA)
    root = new_path(spark, "runs-idem")
    R.append_runs(runs, vals, root)
    R.append_runs(runs, vals, root)  # a retried job
    assert spark.read.parquet(f"{root}/runs").count() == 1
    assert spark.read.parquet(f"{root}/run_values").count() == 1


def test_scoring_fills_absent_optional_fields(spark):
    from lathe.operators import scoring as SC
    from lathe.operators import validate as V

    body = {"bedrooms": 3.0, "bathrooms": 2.0, "sqft_living": 1500.0, "sqft_lot": 5000.0, "floors": 1.0, "sqft_above": 1500.0}
    cols = ", ".join(f"{c} double" for c in body)
    req = spark.createDataFrame([(1, *body.values(), "98001", None), (2, *body.values(), "98001", 200.0)],
                                f"id int, {cols}, zipcode string, sqft_basement double")
    lookup = spark.createDataFrame([("98001", 5.0)], "zipcode string, income double")
    seen = lambda d: d.withColumn("prediction", d["sqft_basement"] + d["income"])
    run = lambda r: {x["id"]: (x["prediction"], x["error_code"]) for x in SC.score(
        r, lookup, "zipcode", seen, SC.CORE_FEATURES + ["income"], V.minimal_request_rules(), ["id"], "1", "m").collect()}
    assert run(req) == {1: (5.0, None), 2: (205.0, None)}
    assert run(req.drop("sqft_basement"))[2] == (5.0, None)


def test_sweep_searches_once_for_runs_that_weigh_the_same_neighbours(spark, tmp_path, monkeypatch):
    from lathe.operators import pipeline as P
    from lathe.plans import q_runs as Q

    rows = [(i, f"name {'x' * (i % 11)}", f"brand{i % 3}", f"type{i % 4}", i % 13, 900.0 + i % 50) for i in range(300)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
                                "p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    searched, join = [], P.knn_join
    monkeypatch.setattr(P, "knn_join", lambda *a, **b: searched.append(1) or join(*a, **b))
    runs, values = Q.sweep_tables(spark, str(tmp_path))
    assert len(searched) == 1
    got = {(r.run_id, r.key): r.value_num for r in values.where("kind = 'metric' and key like 'test%'").collect()}
    assert [r.status for r in runs.orderBy("run_id").collect()] == ["FINISHED"] * 6 + ["FAILED"]
    s = Q._parts_split(spark, str(tmp_path))
    for i, weights in ((4, "uniform"), (5, "distance")):
        alone = RegressionPipeline(Q.PART_FEATURES, Q.PART_TARGET, "robust", None, "knn",
                                   {"n_neighbors": 5, "weights": weights}).fit(s.where("split = 'train'"), Q.PART_ID)
        pred = alone.predict(s.where("split = 'test'"), Q.PART_ID)
        mae = pred.agg(F.avg(F.abs(F.col(Q.PART_TARGET) - F.col("prediction")))).first()[0]
        assert abs(got[f"{Q.EXPERIMENT}-{i:03d}", "test_mae"] - mae) < 1e-9
