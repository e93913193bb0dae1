"""Model persistence and registry, boosted trees, evaluation history,
holdout + CV stacking, data-preparation experiments, dataset fingerprint."""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import functions as F

from lathe.operators import evaluate as ev
from lathe.operators.crossval import cv_group_mean
from lathe.operators.features import fit_scaler, log_replace
from lathe.operators.models import booster_params, list_versions, save_model
from lathe.operators.outliers import remove_outliers
from lathe.operators.pipeline import RegressionPipeline, load_pipeline, save_pipeline
from lathe.operators.ridge import fit_ridge, ridge_prediction
from lathe.operators.split import split
from lathe.plans import sqlparts as S
from lathe.plans.boost_sql import booster_sql
from lathe.plans.q_knn import SPLIT_PARTS, _knn_sql, split_parts
from lathe.plans.q_runs import EXPERIMENT, SWEEP_SQL, sweep_tables
from lathe.plans.registry import register, rounded
from lathe.session import materialize, new_path
from lathe.sources.sinks import fingerprint
from lathe.sources.tables import PART_FEATURES, PART_ID, PART_TARGET, SALES_ID, read_table, sales_frame


@register("model_roundtrip", _knn_sql(5, 2, "uniform"))
def q_model_roundtrip(spark, sf):
    """Fit scaler → KNN, save as registry version 1, load by URI, score."""
    s = split_parts(spark, sf)
    pipe = RegressionPipeline(PART_FEATURES, PART_TARGET, "robust", None, "knn", {"n_neighbors": 5}).fit(
        s.filter("split = 'train'"), PART_ID)
    root = new_path(spark, "registry")
    save_pipeline(spark, pipe, root, "parts_knn", 1)
    loaded = load_pipeline(spark, root, "models:/parts_knn/latest")
    pred = loaded.predict(s.filter("split = 'test'"), PART_ID)
    return rounded(pred.select(F.col(PART_ID).alias("qid"), "prediction"), 4)


@register("latest_version", f"""{SWEEP_SQL}
SELECT 'parts_' || model_type AS name, CAST(count(*) AS INTEGER) AS latest_version, count(*) AS n_versions
FROM wide WHERE status = 'FINISHED' GROUP BY model_type""")
def q_latest_version(spark, sf):
    """Register every finished sweep run as the next version of
    ``parts_<model_type>``; the registry listing gives the latest per name."""
    runs, _ = sweep_tables(spark, sf)
    fin = runs.filter("status = 'FINISHED'").select("run_id", "model_type").orderBy("run_id").collect()  # one row per run
    root = new_path(spark, "registry")
    for r in fin:
        save_model(spark, root, f"parts_{r['model_type']}", None, r["model_type"], PART_FEATURES,
                   params={"run_id": r["run_id"]})
    v = list_versions(spark, root)
    return v.groupBy("name").agg(F.max("version").alias("latest_version"), F.count(F.lit(1)).alias("n_versions"))


def _booster_sql(kind):
    p = booster_params(kind)
    src = f"{SPLIT_PARTS.replace('WITH ', 'WITH RECURSIVE ', 1)}, src AS (SELECT *, split = 'train' AS train FROM splitted)"
    return (f"{src}, {booster_sql('src', [PART_ID], PART_TARGET, PART_FEATURES, p)} SELECT p_partkey AS qid, "
            f"round(b.prediction, 4) AS prediction FROM boosted b JOIN src USING (p_partkey) WHERE NOT train")


def _booster_query(kind):
    def q(spark, sf):
        """The tuned booster fitted on the training parts, applied to the rest."""
        s = split_parts(spark, sf)
        pipe = RegressionPipeline(PART_FEATURES, PART_TARGET, None, None, kind).fit(s.filter("split = 'train'"), PART_ID)
        pred = pipe.predict(s.filter("split = 'test'"), PART_ID)
        return rounded(pred.select(F.col(PART_ID).alias("qid"), "prediction"), 4)
    return q


register("gbt_regress", _booster_sql("xgboost"))(_booster_query("xgboost"))
register("gbt_regress_alt", _booster_sql("lightgbm"))(_booster_query("lightgbm"))


@register("evaluate_model", f"""{SWEEP_SQL}
SELECT split, n, round(mae, 9) AS mae, round(mse, 6) AS mse, round(rmse, 9) AS rmse, round(r2, 9) AS r2,
       round(mape, 9) AS mape, round(wmape, 9) AS wmape FROM m WHERE run_id = '{EXPERIMENT}-004'""")
def q_evaluate_model(spark, sf):
    """KNN pipeline predicted on both splits, metrics per split."""
    s = split_parts(spark, sf)
    pipe = RegressionPipeline(PART_FEATURES, PART_TARGET, "robust", None, "knn", {"n_neighbors": 5}).fit(
        s.filter("split = 'train'"), PART_ID)
    m = ev.regression_metrics(pipe.predict(s, PART_ID), PART_TARGET, "prediction", by=["split"])
    return rounded(m, 9, {"mse": 6})


# ------------------------------------------------------------------ stacking
def _holdout_row(spark, sf):
    from lathe.plans.q_core import scored_sales

    m = ev.regression_metrics(scored_sales(spark, sf), "price", "prediction", by=["split"])
    return ev.performance_summary(ev.overfitting(m)).withColumn("model_name", F.lit("segment_mean"))


def _compare_models_sql():
    from lathe.plans.q_eval import _cv_sql

    return f"""{_cv_sql()},
{S.split('sales', 'o_orderkey')},
mm AS (SELECT c_mktsegment AS mk, avg(price) AS mp FROM splitted WHERE split = 'train' GROUP BY 1),
sc AS (SELECT s.*, coalesce(mm.mp, (SELECT avg(price) FROM splitted WHERE split = 'train')) AS prediction
       FROM splitted s LEFT JOIN mm ON s.c_mktsegment = mm.mk),
m AS (SELECT split, {S.metric_select('price', 'prediction')} FROM sc GROUP BY split),
h AS (SELECT 'segment_mean' AS model_name,
        max(CASE WHEN split = 'test' THEN r2 END) AS test_r2, max(CASE WHEN split = 'train' THEN r2 END) AS train_r2,
        max(CASE WHEN split = 'test' THEN mae END) AS test_mae FROM m)
SELECT model_name, CASE WHEN test_r2 >= 0.9 THEN 'Excellent' WHEN test_r2 >= 0.8 THEN 'Good' WHEN test_r2 >= 0.7 THEN 'Fair'
  WHEN test_r2 >= 0.5 THEN 'Poor' ELSE 'Very Poor' END AS performance_level, round(test_r2, 6) AS test_r2,
  round(train_r2, 6) AS train_r2, round(test_mae, 4) AS test_mae, NULL::DOUBLE AS cv_test_mean_absolute_error_mean,
  NULL::DOUBLE AS cv_test_r2_mean FROM h
UNION ALL
SELECT 'segment_mean_cv', NULL, NULL, NULL, NULL,
  (SELECT round(avg(-score), 4) FROM long WHERE metric = 'test_neg_mean_absolute_error'),
  (SELECT round(avg(score), 4) FROM long WHERE metric = 'test_r2')"""


@register("compare_models", _compare_models_sql())
def q_compare_models(spark, sf):
    """Holdout and cross-validation results stacked into one frame; columns a
    row lacks are NULL (``unionByName(allowMissingColumns=True)``)."""
    h = _holdout_row(spark, sf).select("model_name", "performance_level", F.round("test_r2", 6).alias("test_r2"),
                                       F.round("train_r2", 6).alias("train_r2"), F.round("test_mae", 4).alias("test_mae"))
    cv = ev.cv_statistics(cv_group_mean(sales_frame(spark, sf), [SALES_ID], "c_mktsegment", "price", 5, 42))
    cvw = cv.groupBy().pivot("metric", ["test_mean_absolute_error", "test_r2"]).agg(F.first("mean"))
    cvw = cvw.select(F.lit("segment_mean_cv").alias("model_name"),
                     F.round("test_mean_absolute_error", 4).alias("cv_test_mean_absolute_error_mean"),
                     F.round("test_r2", 4).alias("cv_test_r2_mean"))
    return h.unionByName(cvw, allowMissingColumns=True)


# ------------------------------------------------------------------ prep experiments
TEST_SIZES = [0.2, 0.25, 0.3]
SCALERS = ["robust", "standard", "minmax"]
FEATURE_MODES = ["none", "log_transform", "poly2"]
OUTLIER_FLAGS = [False, True]


KNOWN_FEATURE_MODES = {"none", "log_transform", "poly2"}


MODE_COLUMNS = {"none": ["x"], "log_transform": ["xlog"], "poly2": ["x", "xsq"]}
PENALTY = 1000.0


def prep_experiments(spark, sf, feature_modes=None):
    """Every (test size, scaler, feature mode, outlier flag) variant, each with
    its own fit: the order's quantity (0 without lines), engineered by the
    mode, scaled by the scaler fitted on the training rows, feeds a ridge
    regression of the price, whose penalty acts on the scaled columns. The
    nine fits over one row set share its passes."""
    from lathe.plans.q_prep import enriched_sales

    modes = list(feature_modes or FEATURE_MODES)
    unknown = [m for m in modes if m not in KNOWN_FEATURE_MODES]
    if unknown:
        raise ValueError(f"No such feature mode: {unknown[0]}")
    x = F.coalesce("sum_qty", F.lit(0.0))
    base = enriched_sales(spark, sf).select(SALES_ID, "price", x.alias("x"))
    base = log_replace(base.withColumn("xlog", F.col("x")), ["xlog"]).withColumn("xsq", F.col("x") * F.col("x"))
    raw = sorted({c for m in modes for c in MODE_COLUMNS[m]})
    parts = []
    for ts, out in itertools.product(TEST_SIZES, OUTLIER_FLAGS):
        rows = remove_outliers(base, "price", 1.5) if out else base
        s = materialize(split(rows, [SALES_ID], ts, 42), "prep-split")
        train, wide = s.filter("split = 'train'"), s
        for scaler in SCALERS:
            fitted = fit_scaler(train, raw, scaler)
            wide = wide.select("*", *[((F.col(c) - F.lit(fitted["center"][c])) / F.lit(fitted["scale"][c])).alias(
                f"{scaler}_{c}") for c in raw])
        models = {f"{sc}|{m}": [f"{sc}_{c}" for c in MODE_COLUMNS[m]] for sc in SCALERS for m in modes}
        fits = fit_ridge(wide.filter("split = 'train'"), models, "price", PENALTY)
        variant = F.explode(F.array(*[F.struct(
            F.lit(name.split("|")[0]).alias("scaler"), F.lit(name.split("|")[1]).alias("feature_mode"),
            ridge_prediction(fit).alias("prediction")) for name, fit in fits.items()])).alias("v")
        parts.append(wide.filter("split = 'test'").select("price", variant).select(
            "price", "v.*", F.lit(ts).alias("test_size"), F.lit(out).alias("remove_outliers")))
    allsc = functools.reduce(lambda p, q: p.unionByName(q), parts)
    m = ev.regression_metrics(allsc, "price", "prediction", by=["test_size", "scaler", "feature_mode", "remove_outliers"])
    return m.select("test_size", "scaler", "feature_mode", "remove_outliers", F.col("n").alias("n_test"),
                    F.round("mae", 4).alias("test_mae"), F.round("r2", 6).alias("test_r2"))


def _prep_sql():
    from lathe.plans.q_prep import ENRICHED_SQL

    cols, blocks, out = ["x", "xlog", "xsq"], [], []
    center = {"robust": "quantile_cont({c}, 0.5)", "standard": "avg({c})", "minmax": "min({c})"}
    spread = {"robust": "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)", "standard": "stddev_pop({c})",
              "minmax": "max({c}) - min({c})"}
    for ts, drop in itertools.product(TEST_SIZES, OUTLIER_FLAGS):
        t = f"t{int(ts * 100)}{'o' if drop else 'n'}"
        fits = ", ".join(f"{center[k].format(c=c)} AS c_{k}_{c}, coalesce(nullif({spread[k].format(c=c)}, 0), 1) AS s_{k}_{c}"
                         for k in SCALERS for c in cols)
        z = ", ".join(f"({c} - c_{k}_{c}) / s_{k}_{c} AS {k}_{c}" for k in SCALERS for c in cols)
        means = ", ".join(f"avg({k}_{c}) AS m_{k}_{c}" for k in SCALERS for c in cols)
        d = lambda k, c: f"({k}_{c} - m_{k}_{c})"
        sums = ", ".join(f"sum({d(k, a)} * {'(price - ym)' if b == 'y' else d(k, b)}) AS g_{k}_{a}_{b}" for k in SCALERS
                         for a, b in [("x", "x"), ("xlog", "xlog"), ("xsq", "xsq"), ("x", "xsq"), ("x", "y"), ("xlog", "y"),
                                      ("xsq", "y")])
        blocks.append(f"""{S.split('kept' if drop else 'feats', 'o_orderkey', ts, 42, name='s_' + t)},
p_{t} AS (SELECT {fits} FROM s_{t} WHERE split = 'train'),
z_{t} AS (SELECT price, split, {z} FROM s_{t}, p_{t}),
m_{t} AS (SELECT avg(price) AS ym, {means} FROM z_{t} WHERE split = 'train'),
g_{t} AS (SELECT {sums} FROM z_{t}, m_{t} WHERE split = 'train'),
e_{t} AS (SELECT * FROM z_{t}, m_{t}, g_{t} WHERE split = 'test')""")
        for k, mode in itertools.product(SCALERS, FEATURE_MODES):
            if mode == "poly2":
                a, b = f"(g_{k}_x_x + {PENALTY})", f"(g_{k}_xsq_xsq + {PENALTY})"
                det = f"({a} * {b} - g_{k}_x_xsq * g_{k}_x_xsq)"
                pred = (f"ym + ({b} * g_{k}_x_y - g_{k}_x_xsq * g_{k}_xsq_y) / {det} * {d(k, 'x')}"
                        f" + ({a} * g_{k}_xsq_y - g_{k}_x_xsq * g_{k}_x_y) / {det} * {d(k, 'xsq')}")
            else:
                c = MODE_COLUMNS[mode][0]
                pred = f"ym + g_{k}_{c}_y / (g_{k}_{c}_{c} + {PENALTY}) * {d(k, c)}"
            out.append(f"SELECT CAST({ts} AS DOUBLE) AS test_size, '{k}' AS scaler, '{mode}' AS feature_mode, "
                       f"{str(drop).lower()} AS remove_outliers, price, {pred} AS prediction FROM e_{t}")
    return f"""{ENRICHED_SQL},
feats AS (SELECT o_orderkey, price, coalesce(sum_qty, 0.0) AS x, ln(1.0 + coalesce(sum_qty, 0.0)) AS xlog,
                 coalesce(sum_qty, 0.0) * coalesce(sum_qty, 0.0) AS xsq FROM enriched),
b AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM feats),
kept AS (SELECT feats.* FROM feats, b WHERE price >= q1 - 1.5 * (q3 - q1) AND price <= q3 + 1.5 * (q3 - q1)),
{','.join(blocks)},
allr AS ({' UNION ALL '.join(out)}),
m AS (SELECT test_size, scaler, feature_mode, remove_outliers, {S.metric_select('price', 'prediction')} FROM allr
      GROUP BY ALL)
SELECT test_size, scaler, feature_mode, remove_outliers, n AS n_test, round(mae, 4) AS test_mae, round(r2, 6) AS test_r2
FROM m"""


@register("prep_experiments", _prep_sql())
def q_prep_experiments(spark, sf):
    return prep_experiments(spark, sf)


FP_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate"]
# doubles as decimal text: engines print doubles differently
_FP_SQL = {c: f"CAST({'CAST(o_totalprice AS DECIMAL(18, 2))' if c == 'o_totalprice' else c} AS VARCHAR)" for c in FP_COLS}


@register("dataset_fingerprint", f"""WITH h AS (SELECT md5(concat_ws('|', {', '.join(
  f"coalesce(length({x}) || ':' || {x}, '-')" for x in _FP_SQL.values())})) AS m FROM orders)
SELECT count(*) AS n_rows, {len(FP_COLS)} AS n_cols,
  CAST(sum(CAST(('0x' || substr(m, 1, 16)) AS UBIGINT)) AS HUGEINT)::VARCHAR || '-' ||
  CAST(sum(CAST(('0x' || substr(m, 17, 16)) AS UBIGINT)) AS HUGEINT)::VARCHAR AS digest,
  'o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:decimal(18,2),o_orderpriority:string,'
  || 'o_orderdate:timestamp_ntz' AS schema FROM h""")
def q_fingerprint(spark, sf):
    orders = read_table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return fingerprint(orders, FP_COLS)
