"""Minimal slice: scan → broadcast enrichment → exact split → group-mean
model → one-pass metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.operators import evaluate as ev
from lathe.operators.enrich import enrich
from lathe.operators.models import fit_group_mean, predict_group_mean
from lathe.operators.split import split
from lathe.plans import sqlparts as S
from lathe.plans.registry import register, rounded
from lathe.session import materialize
from lathe.sources.tables import SALES_ID, SALES_KEY, lookup_frame, sales_frame


def scored_sales(spark, sf_dir, model_key="c_mktsegment", test_size=0.2):
    """Sales enriched with the lookup, split 80/20, scored by the mean price
    of the training rows per ``model_key``."""
    sales = enrich(sales_frame(spark, sf_dir), lookup_frame(spark, sf_dir), SALES_KEY)
    # the split feeds both the fit and the scoring: written once, read twice
    s = materialize(split(sales, [SALES_ID], test_size=test_size, seed=42), "sales-split")
    model = fit_group_mean(s.filter(F.col("split") == "train"), model_key, "price")
    return predict_group_mean(s, model, model_key)


SCORED_SQL = f"""WITH {S.SALES}, {S.LOOKUP},
enriched AS (SELECT s.*, l.n_customers, l.avg_acctbal, l.min_acctbal, l.max_acctbal
             FROM sales s LEFT JOIN lookup l ON s.c_nationkey = l.lk),
{S.split('enriched', 'o_orderkey')},
model AS (SELECT c_mktsegment AS mk, avg(price) AS mp FROM splitted WHERE split = 'train' GROUP BY 1),
gmodel AS (SELECT avg(price) AS gp FROM splitted WHERE split = 'train'),
scored AS (SELECT s.*, coalesce(m.mp, g.gp) AS prediction
           FROM splitted s LEFT JOIN model m ON s.c_mktsegment = m.mk CROSS JOIN gmodel g)"""


def _metrics_sql(by: str = "", where: str = "") -> str:
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return f"""{SCORED_SQL},
m AS (SELECT {sel}{S.metric_select('price', 'prediction')} FROM scored {where}{grp})
SELECT {sel}n, round(mae, 4) AS mae, round(mse, 2) AS mse, round(rmse, 4) AS rmse, round(r2, 6) AS r2,
       round(mape, 6) AS mape, round(wmape, 6) AS wmape FROM m"""


METRIC_DIGITS = {"mae": 4, "mse": 2, "rmse": 4, "r2": 6, "mape": 6, "wmape": 6}


@register("regression_metrics", _metrics_sql(where="WHERE split = 'test'"))
def q_regression_metrics(spark, sf_dir):
    sc = scored_sales(spark, sf_dir).filter(F.col("split") == "test")
    return rounded(ev.regression_metrics(sc, "price", "prediction"), per_col=METRIC_DIGITS)


@register("metrics_by_group", _metrics_sql(by="split, c_mktsegment"))
def q_metrics_by_group(spark, sf_dir):
    sc = scored_sales(spark, sf_dir)
    return rounded(ev.regression_metrics(sc, "price", "prediction", by=["split", "c_mktsegment"]),
                   per_col=METRIC_DIGITS)


def entry_query(spark, sf_dir):
    """Flagship: per-split metrics of the enriched, split, scored sales."""
    sc = scored_sales(spark, sf_dir)
    return rounded(ev.regression_metrics(sc, "price", "prediction", by=["split"]), per_col=METRIC_DIGITS)
