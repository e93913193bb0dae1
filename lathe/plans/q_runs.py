"""Model sweep over the parts table, run tables, best run, comparison,
expectation gate; holdout + CV stacking; data-preparation experiments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lathe.operators import evaluate as ev
from lathe.operators import runs as R
from lathe.operators.models import fit_group_mean, predict_group_mean
from lathe.operators.pipeline import RegressionPipeline
from lathe.operators.split import split
from lathe.plans import sqlparts as S
from lathe.plans.q_knn import PARTS_SQL, _d2_sql
from lathe.plans.registry import register, rounded
from lathe.session import materialize
from lathe.sources.tables import PART_FEATURES, PART_ID, PART_TARGET, read_table

EXPERIMENT = "parts_sweep"
START = dt.datetime(2024, 1, 1)
GROUP_KEYS = {"global_mean": None, "size_mean": "p_size", "brand_mean": "p_brand", "type_mean": "p_type"}
SPECS = [("global_mean", "group_mean"), ("size_mean", "group_mean"), ("brand_mean", "group_mean"),
         ("type_mean", "group_mean"), ("knn_uniform", "knn"), ("knn_distance", "knn"), ("unknown_model", "unknown")]


def _parts_split(spark, sf):
    p = read_table(spark, sf, "part").select(
        PART_ID, PART_TARGET, "p_brand", "p_type", F.col("p_size").cast("double").alias("p_size"),
        (F.col("p_partkey") % 97).cast("double").alias("key_mod"), F.length("p_name").cast("double").alias("name_len"))
    return split(p, [PART_ID], 0.2, 42)


def _score_fn(run_name, model_type, found):
    """``found``: neighbours by what they depend on, so that runs which differ
    in how they weigh them search once."""
    def fn(s):
        train = s.filter("split = 'train'")
        if model_type == "group_mean":
            key = GROUP_KEYS[run_name] or []
            return predict_group_mean(s, fit_group_mean(train, key, PART_TARGET), key)
        pipe = RegressionPipeline(PART_FEATURES, PART_TARGET, "robust", None, model_type,
                                  {"n_neighbors": 5, "weights": run_name.split("_")[1] if "_" in run_name else "uniform"})
        if pipe.fit(train, PART_ID).search() not in found:
            found[pipe.search()] = materialize(pipe.neighbours(s, PART_ID), "neighbours")
        return pipe.predict(s, PART_ID, neighbours=found[pipe.search()])
    return fn


def sweep_tables(spark, sf):
    found = {}
    specs = [{"run_name": n, "model_type": t, "score": _score_fn(n, t, found)} for n, t in SPECS]
    # every run fits and scores on the same split: written once, read by all
    return R.sweep(spark, materialize(_parts_split(spark, sf), "parts-split"), specs, PART_TARGET, EXPERIMENT, START,
                   params={"test_size": 0.2, "random_state": 42, "n_features": len(PART_FEATURES)})


def sweep_wide(spark, sf):
    runs, vals = sweep_tables(spark, sf)
    return R.runs_wide(runs, vals)


# ------------------------------------------------------------------ oracle SQL
def _sweep_sql():
    scaled = ", ".join(
        f"({f} - (SELECT c FROM prm WHERE feature = '{f}')) / (SELECT s FROM prm WHERE feature = '{f}') AS {f}"
        for f in PART_FEATURES)
    prm = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, quantile_cont({f}, 0.5) AS c, CASE WHEN quantile_cont({f}, 0.75) - "
        f"quantile_cont({f}, 0.25) = 0 THEN 1.0 ELSE quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) END AS s "
        f"FROM splitted WHERE split = 'train'" for f in PART_FEATURES)
    parts = PARTS_SQL.replace("SELECT p_partkey, p_retailprice,", "SELECT p_partkey, p_retailprice, p_brand, p_type,")
    scored = []
    for i, (name, mtype) in enumerate(SPECS):
        rid = f"{EXPERIMENT}-{i:03d}"
        if mtype == "group_mean":
            key = GROUP_KEYS[name]
            if key is None:
                scored.append(f"SELECT '{rid}' AS run_id, split, p_retailprice AS y, "
                              f"(SELECT avg(p_retailprice) FROM splitted WHERE split = 'train') AS prediction FROM splitted")
            else:
                scored.append(
                    f"SELECT '{rid}' AS run_id, s.split, s.p_retailprice AS y, coalesce(m.mp, "
                    f"(SELECT avg(p_retailprice) FROM splitted WHERE split = 'train')) AS prediction FROM splitted s "
                    f"LEFT JOIN (SELECT {key} AS mk, avg(p_retailprice) AS mp FROM splitted WHERE split = 'train' "
                    f"GROUP BY 1) m ON s.{key} = m.mk")
        elif mtype == "knn":
            if name.endswith("uniform"):
                pred = "avg(y)"
            else:
                pred = ("CASE WHEN sum(CASE WHEN d = 0 THEN 1 ELSE 0 END) > 0 THEN avg(CASE WHEN d = 0 THEN y END) "
                        "ELSE sum(CASE WHEN d <> 0 THEN y / d END) / sum(CASE WHEN d <> 0 THEN 1.0 / d END) END")
            scored.append(f"SELECT '{rid}' AS run_id, any_value(split) AS split, any_value(yq) AS y, {pred} AS prediction "
                          f"FROM knn WHERE rank <= 5 GROUP BY qid")
    pick = ", ".join(f"max(CASE WHEN split = '{s}' THEN {m} END) AS {s}_{m}" for s in ("train", "test")
                     for m in ev.METRICS)
    return f"""WITH {parts}, {S.split('parts', 'p_partkey')}, prm AS ({prm}),
sc AS (SELECT p_partkey, p_retailprice, split, {scaled} FROM splitted),
q AS (SELECT * FROM sc), t AS (SELECT * FROM sc WHERE split = 'train'),
pairs AS (SELECT q.p_partkey AS qid, q.split, q.p_retailprice AS yq, t.p_partkey AS pid, t.p_retailprice AS y,
                 {_d2_sql(PART_FEATURES)} AS ok FROM q, t),
knn AS (SELECT *, sqrt(ok) AS d, row_number() OVER (PARTITION BY qid ORDER BY ok, pid) AS rank FROM pairs),
scored AS ({' UNION ALL '.join(scored)}),
m AS (SELECT run_id, split, {S.metric_select('y', 'prediction')} FROM scored GROUP BY 1, 2),
w AS (SELECT run_id, {pick} FROM m GROUP BY run_id),
o AS (SELECT *, CASE WHEN train_mae > 0 THEN test_mae / train_mae END AS overfitting_ratio_mae,
  CASE WHEN test_r2 > 0 THEN train_r2 / test_r2 END AS overfitting_ratio_r2,
  CASE WHEN train_mape > 0 THEN test_mape / train_mape END AS overfitting_ratio_mape,
  CASE WHEN train_wmape > 0 THEN test_wmape / train_wmape END AS overfitting_ratio_wmape,
  train_r2 - test_r2 AS r2_gap, train_r2 - test_r2 AS overfitting_r2_diff, test_mae - train_mae AS mae_gap,
  test_rmse - train_rmse AS rmse_gap, test_mape - train_mape AS mape_gap, test_wmape - train_wmape AS wmape_gap FROM w),
runs AS (SELECT * FROM (VALUES {', '.join(
        f"('{EXPERIMENT}-{i:03d}', '{n}', '{t}', '{'FINISHED' if t != 'unknown' else 'FAILED'}', "
        f"TIMESTAMP '{(START + dt.timedelta(minutes=i)).isoformat(sep=' ')}')" for i, (n, t) in enumerate(SPECS))})
        AS v(run_id, run_name, model_type, status, start_time)),
wide AS (SELECT r.*, o.* EXCLUDE (run_id) FROM runs r LEFT JOIN o USING (run_id))"""


def _digits(c):
    return 6 if "mse" in c.replace("rmse", "") else 9


SWEEP_SQL = _sweep_sql()
_WIDE_COLS = ", ".join(f'round({m}, {_digits(m)}) AS "metrics.{m}"' for m in R.RUN_METRICS)


def _rw(df):
    return rounded(df, 9, {c: _digits(c) for c in df.columns})


@register("runs_long_to_wide", f"""{SWEEP_SQL}
SELECT run_id, status, start_time, model_type AS "tags.model_type", run_name AS "tags.mlflow.runName", {_WIDE_COLS}
FROM wide""")
def q_runs_wide(spark, sf):
    w = sweep_wide(spark, sf)
    return _rw(w.select("run_id", "status", "start_time", "`tags.model_type`", "`tags.mlflow.runName`",
                        *[f"`metrics.{m}`" for m in R.RUN_METRICS]))


@register("runs_finished", f"{SWEEP_SQL} SELECT run_id, run_name FROM wide WHERE status = 'FINISHED'")
def q_runs_finished(spark, sf):
    runs, _ = sweep_tables(spark, sf)
    return R.finished(runs).select("run_id", "run_name")


@register("best_run", f"""{SWEEP_SQL}
SELECT run_id, run_name, round(test_r2, 9) AS metric_value, start_time, model_type FROM wide
WHERE test_r2 IS NOT NULL AND NOT isnan(test_r2) ORDER BY test_r2 DESC, start_time, run_id LIMIT 1""")
def q_best_run(spark, sf):
    """Beside every finished run stands a FAILED twin with a better score,
    which must not win."""
    w = sweep_wide(spark, sf)
    twins = w.withColumn("run_id", F.concat("run_id", F.lit("-failed"))).withColumn("status", F.lit("FAILED")).withColumn(
        "metrics.test_r2", F.col("`metrics.test_r2`") + 1.0)
    return _rw(R.best_run(w.unionByName(twins), "test_r2", True))


@register("best_model", f"""{SWEEP_SQL}
SELECT run_id, run_name, round(test_mae, 9) AS metric_value, start_time, model_type FROM wide
WHERE test_mae IS NOT NULL AND NOT isnan(test_mae) ORDER BY test_mae, start_time, run_id LIMIT 1""")
def q_best_model(spark, sf):
    return _rw(R.best_run(sweep_wide(spark, sf), "test_mae", False))


@register("runs_ordered", f"""{SWEEP_SQL}
SELECT run_id, round(test_r2, 9) AS test_r2,
       CAST(row_number() OVER (ORDER BY test_r2 DESC NULLS LAST, start_time, run_id) AS INTEGER) AS position FROM wide""")
def q_runs_ordered(spark, sf):
    return _rw(R.ordered(sweep_wide(spark, sf), "test_r2").select("run_id", F.col("`metrics.test_r2`").alias("test_r2"),
                                                                 "position"))


@register("champion", f"""{SWEEP_SQL}
SELECT (SELECT run_name FROM wide WHERE status = 'FINISHED' AND test_r2 IS NOT NULL
        ORDER BY test_r2 DESC, start_time LIMIT 1) AS champion,
       (SELECT round(max(test_r2), 9) FROM wide WHERE status = 'FINISHED') AS test_r2,
       (SELECT count(*) FROM wide WHERE status = 'FINISHED') AS n_finished,
       (SELECT count(*) FROM wide WHERE status = 'FAILED') AS n_failed""")
def q_champion(spark, sf):
    w = sweep_wide(spark, sf)
    best = R.best_run(R.finished(w), "test_r2")
    # one aggregate over the union of the best row and every run: no join
    rows = best.select(F.col("run_name").alias("champion"), F.col("metric_value").alias("test_r2"),
                       F.lit(None).cast("string").alias("status")).unionByName(
        w.select(F.lit(None).cast("string").alias("champion"), F.lit(None).cast("double").alias("test_r2"), "status"))
    out = rows.agg(F.max("champion").alias("champion"), F.max("test_r2").alias("test_r2"),
                   F.count(F.when(F.col("status") == "FINISHED", 1)).alias("n_finished"),
                   F.count(F.when(F.col("status") == "FAILED", 1)).alias("n_failed"))
    return _rw(out)


@register("compare_runs", f"""{SWEEP_SQL}
SELECT run_id, run_name AS "mlflow.runName", model_type, start_time, status, round(test_r2, 9) AS test_r2,
       round(test_mae, 9) AS test_mae, round(test_rmse, 9) AS test_rmse, round(train_r2, 9) AS train_r2,
       round(overfitting_ratio_r2, 9) AS overfitting_ratio_r2 FROM wide WHERE status = 'FINISHED'""")
def q_compare_runs(spark, sf):
    return _rw(R.compare_runs(R.finished(sweep_wide(spark, sf))))


_EXP_SQL = ", ".join(f"('{m}', CAST({r} AS DOUBLE), CAST({t} AS DOUBLE))" for m, r, t in R.EXPECTATIONS)


@register("expectation_gate", f"""{SWEEP_SQL},
ex AS (SELECT * FROM (VALUES {_EXP_SQL}) AS v(model_type, min_r2, max_training_time))
SELECT w.run_id, ex.model_type, round(w.test_r2, 9) AS test_r2, ex.min_r2, coalesce(w.test_r2 >= ex.min_r2, false) AS r2_ok,
  ex.max_training_time > 0 AS time_ok, ex.max_training_time > 0 AND coalesce(w.test_r2 >= ex.min_r2, false) AS passed
FROM wide w JOIN ex ON w.model_type = ex.model_type
UNION ALL SELECT w.run_id || '-slow', ex.model_type, round(w.test_r2, 9), ex.min_r2, coalesce(w.test_r2 >= ex.min_r2, false),
  false, false FROM wide w JOIN ex ON w.model_type = ex.model_type""")
def q_expectation_gate(spark, sf):
    exp = spark.createDataFrame(R.EXPECTATIONS, "model_type string, min_r2 double, max_training_time double")
    w = sweep_wide(spark, sf)
    # a twin of each run that took an hour longer: the recorded time decides
    slow = w.withColumn("run_id", F.concat("run_id", F.lit("-slow"))).withColumn(
        "metrics.training_time_s", F.col("`metrics.training_time_s`") + 3600.0)
    g = R.expectation_gate(w.unionByName(slow), exp)
    return _rw(g.select("run_id", "model_type", "test_r2", "min_r2", "r2_ok", "time_ok", "passed"))


@register("model_sweep", f"""{SWEEP_SQL}
SELECT run_name, model_type, status, CASE WHEN status = 'FAILED' THEN 'ValueError: unknown model unknown' END AS error,
       round(test_r2, 9) AS test_r2 FROM wide""")
def q_model_sweep(spark, sf):
    runs, vals = sweep_tables(spark, sf)
    w = R.runs_wide(runs, vals)
    return _rw(w.select("run_name", "model_type", "status", "error", F.col("`metrics.test_r2`").alias("test_r2")))


@register("runs_store_roundtrip", f"""{SWEEP_SQL}
SELECT run_id, status, CAST(count(*) AS BIGINT) AS n_values FROM (
  SELECT run_id, status FROM wide CROSS JOIN (SELECT unnest(range(3 + 3)) AS i) WHERE status = 'FAILED'
  UNION ALL SELECT run_id, status FROM wide CROSS JOIN (SELECT unnest(range(3 + 3 + {len(R.RUN_METRICS)})) AS i)
  WHERE status = 'FINISHED') GROUP BY 1, 2""")
def q_runs_store(spark, sf):
    """Append the sweep to the runs store (Parquet, partitioned by
    experiment) and read it back."""
    from lathe.session import new_path

    runs, vals = sweep_tables(spark, sf)
    root = new_path(spark, "runs-store")
    R.append_runs(runs, vals, root)
    r = spark.read.parquet(f"{root}/runs")
    v = spark.read.parquet(f"{root}/run_values")
    return (r.join(v.select("run_id"), "run_id").groupBy("run_id", "status")
            .agg(F.count(F.lit(1)).alias("n_values")))
