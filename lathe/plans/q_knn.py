"""Neighbour join, KNN regression (uniform / distance / Manhattan), grid
evaluation in one join, KNN cross-validation in one join, and the
scaler → k-best → KNN pipeline. Oracles are brute force in DuckDB."""

from __future__ import annotations

import functools

from pyspark.sql import Window
from pyspark.sql import functions as F

from lathe.operators import evaluate as ev
from lathe.operators import features as FE
from lathe.operators.knn import knn_join, knn_regress
from lathe.operators.search import KNN_SPACE
from lathe.operators.split import kfold, split
from lathe.plans import sqlparts as S
from lathe.plans.registry import register, rounded
from lathe.session import materialize
from lathe.sources.tables import PART_FEATURES, PART_ID, PART_TARGET, parts_frame

PARTS_SQL = """parts AS (SELECT p_partkey, p_retailprice, CAST(p_size AS DOUBLE) AS p_size,
  CAST(p_partkey % 97 AS DOUBLE) AS key_mod, CAST(length(p_name) AS DOUBLE) AS name_len FROM part)"""
SPLIT_PARTS = f"WITH {PARTS_SQL}, {S.split('parts', 'p_partkey')}"


def split_parts(spark, sf):
    """Parts split 80/20, written once (it feeds both the fit and the queries)."""
    return materialize(split(parts_frame(spark, sf), [PART_ID], 0.2, 42), "parts-split")


def _d2_sql(feats, p=2, a="q", b="t", sel=None):
    terms = []
    for f in feats:
        diff = f"({a}.{f} - {b}.{f})"
        t = f"{diff} * {diff}" if p == 2 else f"abs{diff}"
        if sel is not None:
            t = f"(CASE WHEN '{f}' IN (SELECT feature FROM {sel}) THEN {t} ELSE 0.0 END)"
        terms.append(t)
    return " + ".join(terms)


@register("knn_join", f"""{SPLIT_PARTS},
q AS (SELECT * FROM splitted WHERE split = 'test'), t AS (SELECT * FROM splitted WHERE split = 'train'),
pairs AS (SELECT q.p_partkey AS qid, t.p_partkey AS pid, {_d2_sql(PART_FEATURES)} AS d2 FROM q, t),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, pid) AS rank FROM pairs)
SELECT qid, pid, round(sqrt(d2), 6) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def q_knn_join(spark, sf):
    s = split_parts(spark, sf)
    q = s.filter("split = 'test'").select(F.col(PART_ID).alias("qid"), *PART_FEATURES)
    t = s.filter("split = 'train'").select(F.col(PART_ID).alias("pid"), *PART_FEATURES)
    nb = knn_join(q, t, PART_FEATURES, k=5, p=2, qid="qid", pid="pid")
    return rounded(nb.select("qid", "pid", "distance", "rank"), 6)


# ------------------------------------------------------------ scaled pipeline
def _scaled_sql():
    cols = ", ".join(f"({f} - (SELECT c FROM prm WHERE feature = '{f}')) / (SELECT s FROM prm WHERE feature = '{f}') AS {f}"
                     for f in PART_FEATURES)
    prm = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, quantile_cont({f}, 0.5) AS c, CASE WHEN quantile_cont({f}, 0.75) - "
        f"quantile_cont({f}, 0.25) = 0 THEN 1.0 ELSE quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) END AS s "
        f"FROM splitted WHERE split = 'train'" for f in PART_FEATURES)
    return f"""{SPLIT_PARTS}, prm AS ({prm}),
sc AS (SELECT p_partkey, p_retailprice, split, {cols} FROM splitted),
q AS (SELECT * FROM sc WHERE split = 'test'), t AS (SELECT * FROM sc WHERE split = 'train')"""


def _knn_sql(k, p, weights):
    if weights == "uniform":
        pred = "avg(y)"
    else:
        pred = ("CASE WHEN sum(CASE WHEN d = 0 THEN 1 ELSE 0 END) > 0 THEN avg(CASE WHEN d = 0 THEN y END) "
                "ELSE sum(CASE WHEN d <> 0 THEN y / d END) / sum(CASE WHEN d <> 0 THEN 1.0 / d END) END")
    dist = "sqrt(ok)" if p == 2 else "ok"
    return f"""{_scaled_sql()},
pairs AS (SELECT q.p_partkey AS qid, t.p_partkey AS pid, t.p_retailprice AS y, {_d2_sql(PART_FEATURES, p)} AS ok FROM q, t),
r AS (SELECT *, {dist} AS d, row_number() OVER (PARTITION BY qid ORDER BY ok, pid) AS rank FROM pairs)
SELECT qid, round({pred}, 4) AS prediction FROM r WHERE rank <= {k} GROUP BY qid"""


def scaled_parts(spark, sf):
    s = split_parts(spark, sf)
    params = FE.fit_scaler(s.filter("split = 'train'"), PART_FEATURES, "robust")
    return FE.apply_scaler(s, params)


def knn_predict(spark, sf, k=5, p=2, weights="uniform"):
    sc = scaled_parts(spark, sf)
    q = sc.filter("split = 'test'").select(F.col(PART_ID).alias("qid"), *PART_FEATURES)
    t = sc.filter("split = 'train'").select(F.col(PART_ID).alias("pid"), *PART_FEATURES, PART_TARGET)
    nb = knn_join(q, t, PART_FEATURES, k=k, p=p, qid="qid", pid="pid", payload=[PART_TARGET])
    return knn_regress(nb, "qid", PART_TARGET, weights)


for _name, _p, _w in (("knn_regress_uniform", 2, "uniform"), ("knn_regress_distance", 2, "distance"),
                      ("knn_regress_manhattan", 1, "uniform")):
    def _mk(p=_p, w=_w):
        def q(spark, sf):
            return rounded(knn_predict(spark, sf, 5, p, w), 4)
        return q
    register(_name, _knn_sql(5, _p, _w))(_mk())


# ------------------------------------------------------------ grid evaluation
# algorithm and leaf_size choose a search structure, not a result: every
# combination of the space has the figures of its (n_neighbors, weights, p)
KS, PS = KNN_SPACE["n_neighbors"], KNN_SPACE["p"]


def _grid_sql():
    top = " UNION ALL ".join(f"""SELECT * FROM (SELECT {p} AS p, q.p_partkey AS qid, q.p_retailprice AS yq, t.p_partkey AS pid,
  t.p_retailprice AS y, {'sqrt' if p == 2 else ''}({_d2_sql(PART_FEATURES, p)}) AS d,
  row_number() OVER (PARTITION BY q.p_partkey ORDER BY {_d2_sql(PART_FEATURES, p)}, t.p_partkey) AS rank FROM q, t)
  WHERE rank <= {max(KS)}""" for p in PS)
    return f"""{_scaled_sql()}, top AS ({top}),
ks AS (SELECT unnest([{', '.join(map(str, KS))}]) AS n_neighbors),
pu AS (SELECT p, n_neighbors, 'uniform' AS weights, qid, any_value(yq) AS yq, avg(y) AS prediction
       FROM top JOIN ks ON rank <= n_neighbors GROUP BY 1, 2, 3, 4),
pd AS (SELECT p, n_neighbors, 'distance' AS weights, qid, any_value(yq) AS yq,
  CASE WHEN sum(CASE WHEN d = 0 THEN 1 ELSE 0 END) > 0 THEN avg(CASE WHEN d = 0 THEN y END)
       ELSE sum(CASE WHEN d <> 0 THEN y / d END) / sum(CASE WHEN d <> 0 THEN 1.0 / d END) END AS prediction
       FROM top JOIN ks ON rank <= n_neighbors GROUP BY 1, 2, 3, 4),
m AS (SELECT p, n_neighbors, weights, {S.metric_select('yq', 'prediction')}
      FROM (SELECT * FROM pu UNION ALL SELECT * FROM pd) GROUP BY 1, 2, 3)
SELECT p, n_neighbors, weights, n, round(mae, 9) AS mae, round(rmse, 9) AS rmse, round(r2, 9) AS r2,
  row_number() OVER (ORDER BY round(r2, 9) DESC, p, n_neighbors, weights) = 1 AS best FROM m"""


@register("knn_grid_eval", _grid_sql())
def q_knn_grid_eval(spark, sf):
    """The whole effective search space, one neighbour join per metric; the
    best combination is the one with the largest R² (ties: p, k, weights)."""
    sc = materialize(scaled_parts(spark, sf), "scaled-parts")
    q = sc.filter("split = 'test'").select(F.col(PART_ID).alias("qid"), *PART_FEATURES, F.col(PART_TARGET).alias("yq"))
    t = sc.filter("split = 'train'").select(F.col(PART_ID).alias("pid"), *PART_FEATURES, PART_TARGET)
    near = [knn_join(q, t, PART_FEATURES, k=max(KS), p=p, qid="qid", pid="pid", payload=[PART_TARGET]).withColumn(
        "p", F.lit(p)) for p in PS]
    nb = functools.reduce(lambda a, b: a.unionByName(b), near).join(q.select("qid", "yq"), "qid")
    ks = F.explode(F.array(*[F.lit(k) for k in KS])).alias("n_neighbors")
    exp = nb.select("*", ks).filter(F.col("rank") <= F.col("n_neighbors")).withColumn(
        "_g", F.struct("p", "n_neighbors", "qid", "yq"))
    preds = functools.reduce(lambda a, b: a.unionByName(b), [
        knn_regress(exp, "_g", PART_TARGET, w).select("_g.*", F.lit(w).alias("weights"), "prediction")
        for w in KNN_SPACE["weights"]])
    m = ev.regression_metrics(preds, "yq", "prediction", by=["p", "n_neighbors", "weights"])
    m = rounded(m.select("p", "n_neighbors", "weights", "n", "mae", "rmse", "r2"), 9)
    order = Window.orderBy(F.desc("r2"), "p", "n_neighbors", "weights")  # one row per combination of the grid
    return m.withColumn("best", F.row_number().over(order) == 1)


# ------------------------------------------------------------ CV in one join
def _cv_knn_sql(k=5, nn=5):
    return f"""WITH {PARTS_SQL},
r AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || CAST(p_partkey AS VARCHAR)), p_partkey) - 1 AS r0,
             count(*) OVER () AS n FROM parts),
fp AS (SELECT *, CAST(CASE WHEN r0 < (n % {k}) * (n // {k} + 1) THEN r0 // (n // {k} + 1)
         ELSE (n % {k}) + (r0 - (n % {k}) * (n // {k} + 1)) // (n // {k}) END AS INTEGER) AS fold FROM r),
fs AS (SELECT range AS model_fold FROM range({k})),
q AS (SELECT fp.*, fs.model_fold FROM fp CROSS JOIN fs),
pairs AS (SELECT q.p_partkey AS qid, q.model_fold, q.fold, q.p_retailprice AS yq, t.p_partkey AS pid, t.p_retailprice AS y,
                 {_d2_sql(PART_FEATURES)} AS ok FROM q JOIN fp t ON t.fold <> q.model_fold),
rk AS (SELECT *, row_number() OVER (PARTITION BY qid, model_fold ORDER BY ok, pid) AS rank FROM pairs),
pr AS (SELECT qid, model_fold, CASE WHEN any_value(fold) = model_fold THEN 'test' ELSE 'train' END AS part,
              any_value(yq) AS yq, avg(y) AS prediction FROM rk WHERE rank <= {nn} GROUP BY qid, model_fold),
met AS (SELECT model_fold, part, {S.metric_select('yq', 'prediction')} FROM pr GROUP BY 1, 2)"""


@register("cv_knn", f"""{_cv_knn_sql()}
SELECT CAST(model_fold AS INTEGER) AS fold, part || '_neg_mean_absolute_error' AS metric, round(-mae, 9) AS score FROM met
UNION ALL SELECT CAST(model_fold AS INTEGER), part || '_neg_mean_squared_error', round(-mse, 9) FROM met
UNION ALL SELECT CAST(model_fold AS INTEGER), part || '_r2', round(r2, 9) FROM met""")
def q_cv_knn(spark, sf):
    return cv_knn(spark, sf)


def cv_knn(spark, sf, k=5, nn=5):
    """Cross-validated KNN, every fold and role in one neighbour join: the
    query (row, model fold f) may only use points outside fold f; it is a
    test query when the row lies in f, a training-score query otherwise."""
    folded = kfold(parts_frame(spark, sf), [PART_ID], k, 42)
    q = folded.select(F.col(PART_ID).alias("qid"), *PART_FEATURES, "fold", F.col(PART_TARGET).alias("yq"),
                      F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("model_fold"))
    q = q.withColumn("_q", F.struct("qid", "model_fold"))
    t = folded.select(F.col(PART_ID).alias("pid"), *PART_FEATURES, PART_TARGET, "fold")
    nb = knn_join(q, t, PART_FEATURES, k=nn, qid="_q", pid="pid", payload=[PART_TARGET],
                  exclude=("model_fold", "fold"))
    pred = knn_regress(nb, "_q", PART_TARGET, "uniform")
    pred = pred.join(q.select("_q", "fold", "yq"), "_q").select(
        F.col("_q.model_fold").alias("model_fold"),
        F.when(F.col("fold") == F.col("_q.model_fold"), "test").otherwise("train").alias("part"), "yq", "prediction")
    m = ev.regression_metrics(pred, "yq", "prediction", by=["model_fold", "part"])
    long = m.select(F.col("model_fold").alias("fold"), F.explode(F.array(
        F.struct(F.concat("part", F.lit("_neg_mean_absolute_error")).alias("metric"), F.round(-F.col("mae"), 9).alias("score")),
        F.struct(F.concat("part", F.lit("_neg_mean_squared_error")).alias("metric"), F.round(-F.col("mse"), 9).alias("score")),
        F.struct(F.concat("part", F.lit("_r2")).alias("metric"), F.round("r2", 9).alias("score")))).alias("s"))
    return long.select("fold", "s.metric", (F.col("s.score") + F.lit(0.0)).alias("score"))


# ------------------------------------------------------------ pipeline
def _pipeline_sql(kbest=2):
    complete = "split = 'train'"
    f_parts = []
    for i, c in enumerate(PART_FEATURES):
        r = f"(covar_pop({c}, p_retailprice) / sqrt(var_pop({c}) * var_pop(p_retailprice)))"
        f_parts.append(f"SELECT '{c}' AS feature, {i} AS position, CASE WHEN var_pop({c}) = 0 THEN 0.0 "
                       f"WHEN {r} * {r} >= 1 THEN 1.7976931348623157e308 "
                       f"ELSE {r} * {r} / (1 - {r} * {r}) * (count(*) - 2) END AS f FROM splitted WHERE {complete}")
    return f"""{_scaled_sql()},
fsc AS ({' UNION ALL '.join(f_parts)}),
sel AS (SELECT feature FROM fsc ORDER BY f DESC, position DESC LIMIT {kbest}),
pairs AS (SELECT q.p_partkey AS qid, t.p_partkey AS pid, t.p_retailprice AS y, {_d2_sql(PART_FEATURES, 2, sel='sel')} AS ok
          FROM q, t),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY ok, pid) AS rank FROM pairs)
SELECT qid, round(avg(y), 4) AS prediction FROM r WHERE rank <= 5 GROUP BY qid"""


@register("pipeline_knn", _pipeline_sql())
def q_pipeline_knn(spark, sf):
    from lathe.operators.pipeline import RegressionPipeline

    s = split_parts(spark, sf)
    pipe = RegressionPipeline(features=PART_FEATURES, target=PART_TARGET, scaler="robust", k_best=2,
                              model="knn", model_params={"n_neighbors": 5}).fit(s.filter("split = 'train'"), PART_ID)
    pred = pipe.predict(s.filter("split = 'test'"), PART_ID)
    return rounded(pred.select(F.col(PART_ID).alias("qid"), "prediction"), 4)
