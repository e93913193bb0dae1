"""Splits, k-fold, overfitting, tiers, CV statistics, formatting."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.operators import evaluate as ev
from lathe.operators.crossval import cv_group_mean
from lathe.operators.split import kfold, split
from lathe.plans import sqlparts as S
from lathe.plans.q_core import SCORED_SQL, scored_sales
from lathe.plans.registry import register, rounded
from lathe.sources.tables import SALES_ID, sales_frame

SALES_SQL = f"WITH {S.SALES}"


@register("train_test_split", f"{SALES_SQL}, {S.split('sales', 'o_orderkey')} SELECT o_orderkey, split FROM splitted")
def q_train_test_split(spark, sf):
    return split(sales_frame(spark, sf).select(SALES_ID), [SALES_ID], 0.2, 42).select(SALES_ID, "split")


SIZES = [0.15, 0.2, 0.25, 0.3]


@register("split_sizes", f"{SALES_SQL}, n AS (SELECT count(*) AS n_all FROM sales) " + " UNION ALL ".join(
    f"SELECT CAST({t} AS DOUBLE) AS test_size, CAST(n_all - ceil(CAST({t} AS DOUBLE) * n_all) AS BIGINT) AS n_train, "
    f"CAST(ceil(CAST({t} AS DOUBLE) * n_all) AS BIGINT) AS n_test FROM n" for t in SIZES))
def q_split_sizes(spark, sf):
    """The seeded rank does not depend on the test size: rank once, then one
    aggregate counts every size's test/train rows."""
    from lathe.operators.split import RANK, exact_rank

    ranked, _ = exact_rank(sales_frame(spark, sf).select(SALES_ID), [SALES_ID], 42)
    aggs = []
    for i, t in enumerate(SIZES):
        is_test = F.col(RANK) <= F.ceil(F.lit(t) * F.col("_total"))
        aggs += [F.count(F.when(~is_test, 1)).alias(f"tr{i}"), F.count(F.when(is_test, 1)).alias(f"te{i}")]
    row = ranked.agg(*aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("test_size"), F.col(f"tr{i}").alias("n_train"), F.col(f"te{i}").alias("n_test"))
        for i, t in enumerate(SIZES)])).alias("s")).select("s.*")


def _kfold_sql(k=5):
    return f"""{SALES_SQL},
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS r0,
             count(*) OVER () AS n FROM sales),
f AS (SELECT o_orderkey, r0, n, n // {k} AS q, n % {k} AS rem FROM r),
folds AS (SELECT o_orderkey, CAST(CASE WHEN r0 < rem * (q + 1) THEN r0 // (q + 1)
                                   ELSE rem + (r0 - rem * (q + 1)) // q END AS INTEGER) AS fold FROM f)"""


@register("kfold_assign", f"{_kfold_sql()} SELECT o_orderkey, fold FROM folds")
def q_kfold_assign(spark, sf):
    return kfold(sales_frame(spark, sf).select(SALES_ID), [SALES_ID], 5, 42).select(SALES_ID, "fold")


@register("kfold_sizes", f"{_kfold_sql()} SELECT fold, count(*) AS n FROM folds GROUP BY fold")
def q_kfold_sizes(spark, sf):
    return kfold(sales_frame(spark, sf).select(SALES_ID), [SALES_ID], 5, 42).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"))


def _split_metrics(spark, sf, by=()):
    return ev.regression_metrics(scored_sales(spark, sf), "price", "prediction", by=["split", *by])


def _over_sql(by: str, zero: bool) -> str:
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    pick = ", ".join(f"max(CASE WHEN split = '{s}' THEN {m} END) AS {s}_{m}"
                     for m in ev.METRICS for s in ("train", "test"))
    if zero:
        ratio = lambda n, d: f"CASE WHEN {d} <> 0 THEN {n} / {d} ELSE 0.0 END"
        gaps = ("train_r2 - test_r2 AS overfitting_r2_diff, test_mape - train_mape AS overfitting_mape_diff, "
                "test_wmape - train_wmape AS overfitting_wmape_diff, test_mae - train_mae AS mae_gap, "
                "test_mape - train_mape AS mape_gap, test_wmape - train_wmape AS wmape_gap")
    else:
        ratio = lambda n, d: f"CASE WHEN {d} > 0 THEN {n} / {d} END"
        gaps = ("train_r2 - test_r2 AS r2_gap, train_r2 - test_r2 AS overfitting_r2_diff, "
                "test_mae - train_mae AS mae_gap, test_rmse - train_rmse AS rmse_gap, "
                "test_mape - train_mape AS mape_gap, test_wmape - train_wmape AS wmape_gap")
    return f"""{SCORED_SQL},
m AS (SELECT {sel}split, {S.metric_select('price', 'prediction')} FROM scored GROUP BY {sel}split),
w AS (SELECT {sel}{pick} FROM m{grp}),
o AS (SELECT *, {ratio('test_mae', 'train_mae')} AS overfitting_ratio_mae,
  {ratio('train_r2', 'test_r2')} AS overfitting_ratio_r2, {ratio('test_mape', 'train_mape')} AS overfitting_ratio_mape,
  {ratio('test_wmape', 'train_wmape')} AS overfitting_ratio_wmape, {gaps} FROM w)"""


def _round_all_sql(cols, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


_OVER_COLS = ([f"{s}_{m}" for m in ev.METRICS for s in ("train", "test")]
              + ["overfitting_ratio_mae", "overfitting_ratio_r2", "overfitting_ratio_mape", "overfitting_ratio_wmape"])
_GAPS = ["r2_gap", "overfitting_r2_diff", "mae_gap", "rmse_gap", "mape_gap", "wmape_gap"]
_GAPS0 = ["overfitting_r2_diff", "overfitting_mape_diff", "overfitting_wmape_diff", "mae_gap", "mape_gap", "wmape_gap"]
_DIG = {c: 2 for c in _OVER_COLS if "mse" in c}


def _r(df):
    return rounded(df, 6, _DIG)


@register("overfitting_metrics", f"{_over_sql('', False)} SELECT "
          + ", ".join(f"round({c}, {_DIG.get(c, 6)}) AS {c}" for c in _OVER_COLS + _GAPS) + " FROM o")
def q_overfitting(spark, sf):
    return _r(ev.overfitting(_split_metrics(spark, sf)))


@register("overfitting_baseline", f"{_over_sql('', True)} SELECT "
          + ", ".join(f"round({c}, {_DIG.get(c, 6)}) AS {c}" for c in _OVER_COLS + _GAPS0) + " FROM o")
def q_overfitting_baseline(spark, sf):
    return _r(ev.overfitting(_split_metrics(spark, sf), on_zero="zero"))


def _tiers_sql():
    perf = "CASE WHEN test_r2 >= 0.9 THEN 'Excellent' WHEN test_r2 >= 0.8 THEN 'Good' WHEN test_r2 >= 0.7 THEN 'Fair' " \
           "WHEN test_r2 >= 0.5 THEN 'Poor' ELSE 'Very Poor' END"
    ratio = "coalesce(overfitting_ratio_r2, 1.0)"
    ovf = f"CASE WHEN {ratio} <= 1.1 THEN 'Minimal' WHEN {ratio} <= 1.3 THEN 'Moderate' " \
          f"WHEN {ratio} <= 1.5 THEN 'High' ELSE 'Severe' END"
    return f"""{_over_sql('c_mktsegment', False)},
t AS (SELECT c_mktsegment, test_r2, test_mae, overfitting_ratio_r2, {perf} AS performance_level,
             {ovf} AS overfitting_level, {ratio} AS overfitting_ratio FROM o)
SELECT c_mktsegment, round(test_r2, 6) AS test_r2, round(test_mae, 6) AS test_mae,
       round(overfitting_ratio_r2, 6) AS overfitting_ratio_r2, performance_level, overfitting_level,
       round(overfitting_ratio, 6) AS overfitting_ratio,
       CAST(CASE performance_level WHEN 'Excellent' THEN 5.0 WHEN 'Good' THEN 4.0 WHEN 'Fair' THEN 3.0 WHEN 'Poor' THEN 2.0
         WHEN 'Very Poor' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS performance_score,
       CAST(CASE overfitting_level WHEN 'Minimal' THEN 4.0 WHEN 'Moderate' THEN 3.0 WHEN 'High' THEN 2.0
         WHEN 'Severe' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS overfitting_score FROM t"""


@register("performance_summary", _tiers_sql())
def q_performance_summary(spark, sf):
    over = ev.overfitting(_split_metrics(spark, sf, ["c_mktsegment"]), by=["c_mktsegment"])
    out = ev.performance_summary(over).select(
        "c_mktsegment", "test_r2", "test_mae", "overfitting_ratio_r2", "performance_level", "overfitting_level",
        "overfitting_ratio", "performance_score", "overfitting_score")
    return rounded(out, 6)


def _cv_sql(k=5):
    return f"""{SALES_SQL},
r AS (SELECT o_orderkey, price, c_mktsegment,
             row_number() OVER (ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS r0,
             count(*) OVER () AS n FROM sales),
fp AS (SELECT o_orderkey, price, c_mktsegment, CAST(CASE WHEN r0 < (n % {k}) * (n // {k} + 1) THEN r0 // (n // {k} + 1)
         ELSE (n % {k}) + (r0 - (n % {k}) * (n // {k} + 1)) // (n // {k}) END AS INTEGER) AS fold FROM r),
agg AS (SELECT fold, c_mktsegment, sum(price) AS s, count(*) AS c FROM fp GROUP BY 1, 2),
tot AS (SELECT c_mktsegment, sum(s) AS ts, sum(c) AS tc FROM agg GROUP BY 1),
fs AS (SELECT range AS fold FROM range({k})),
grid AS (SELECT fs.fold, t.c_mktsegment, t.ts - coalesce(a.s, 0) AS ms, t.tc - coalesce(a.c, 0) AS mc
         FROM fs CROSS JOIN tot t LEFT JOIN agg a ON a.fold = fs.fold AND a.c_mktsegment = t.c_mktsegment),
gm AS (SELECT fold, sum(ms) / nullif(sum(mc), 0) AS gp FROM grid GROUP BY fold),
model AS (SELECT g.fold, g.c_mktsegment, coalesce(g.ms / nullif(g.mc, 0), gm.gp) AS mp FROM grid g JOIN gm USING (fold)),
scored AS (SELECT fs.fold AS model_fold, CASE WHEN fp.fold = fs.fold THEN 'test' ELSE 'train' END AS part,
                  fp.price, m.mp AS prediction
           FROM fp CROSS JOIN fs JOIN model m ON m.fold = fs.fold AND m.c_mktsegment = fp.c_mktsegment),
met AS (SELECT model_fold, part, {S.metric_select('price', 'prediction')} FROM scored GROUP BY 1, 2),
long AS (
  SELECT model_fold AS fold, part || '_neg_mean_absolute_error' AS metric, -mae AS score FROM met
  UNION ALL SELECT model_fold, part || '_neg_mean_squared_error', -mse FROM met
  UNION ALL SELECT model_fold, part || '_r2', r2 FROM met)"""


@register("cv_statistics", f"""{_cv_sql()},
clean AS (SELECT fold, replace(metric, 'neg_', '') AS metric,
                 CASE WHEN regexp_matches(metric, '^(train_|test_)?neg_') THEN -score ELSE score END AS score FROM long)
SELECT metric, round(avg(score), d) AS mean, round(stddev_pop(score), d) AS std, round(min(score), d) AS min,
       round(max(score), d) AS max, list(round(score, d) ORDER BY fold) AS scores
FROM (SELECT *, CASE WHEN metric LIKE '%squared%' THEN 0 ELSE 4 END AS d FROM clean) GROUP BY metric, d""")
def q_cv_statistics(spark, sf):
    scores = cv_group_mean(sales_frame(spark, sf), [SALES_ID], "c_mktsegment", "price", k=5, seed=42)
    st = ev.cv_statistics(scores)
    # MSE is in squared target units (~1e10): whole units; the rest 4 places.
    sq = F.col("metric").contains("squared")
    rnd = lambda c: F.when(sq, F.round(c, 0)).otherwise(F.round(c, 4))
    return st.select("metric", *[rnd(F.col(c)).alias(c) for c in ("mean", "std", "min", "max")],
                     F.transform("scores", rnd).alias("scores"))


@register("format_metrics", f"""{SCORED_SQL},
m AS (SELECT split, {S.metric_select('price', 'prediction')} FROM scored GROUP BY split),
long AS (SELECT split, 'mae' AS metric, mae AS value FROM m UNION ALL SELECT split, 'rmse', rmse FROM m
         UNION ALL SELECT split, 'r2', r2 FROM m UNION ALL SELECT split, 'mape', mape FROM m
         UNION ALL SELECT split, 'wmape', wmape FROM m)
SELECT split, split || '_' || metric AS metric,
  CASE WHEN metric IN ('mae', 'rmse') THEN '$' || printf('%,.2f', value)
       WHEN metric = 'r2' THEN printf('%.4f', value) ELSE printf('%.2f', value) || '%' END AS display FROM long""")
def q_format_metrics(spark, sf):
    m = _split_metrics(spark, sf)
    long = m.select("split", F.explode(F.array(*[F.struct(F.lit(x).alias("metric"), F.col(x).alias("value"))
                                                 for x in ("mae", "rmse", "r2", "mape", "wmape")])).alias("s"))
    return long.select("split", F.concat_ws("_", "split", "s.metric").alias("metric"),
                       ev.format_metric(F.concat_ws("_", "split", "s.metric"), F.col("s.value")).alias("display"))


@register("percent_diff", """SELECT o_orderkey, round(CASE WHEN o_totalprice = 0 THEN 0.0
  ELSE (o_totalprice - o_totalprice * 0.9) / o_totalprice * 100 END, 6) AS pct FROM orders""")
def q_percent_diff(spark, sf):
    from lathe.functions.columns import pct_diff
    from lathe.sources.tables import read_table

    o = read_table(spark, sf, "orders")
    return rounded(o.select("o_orderkey", pct_diff(F.col("o_totalprice"), F.col("o_totalprice") * 0.9).alias("pct")), 6)
