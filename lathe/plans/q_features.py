"""Scalers, log transforms, polynomial features, F scores, k-best."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.operators import features as FE
from lathe.plans.q_prep import ALL_FEATURES, ENRICHED_SQL, enriched_sales
from lathe.plans.registry import register, rounded


def _params_frame(spark, params):
    rows = [(c, i, float(params["center"][c]), float(params["scale"][c])) for i, c in enumerate(params["center"])]
    return spark.createDataFrame(rows, "feature string, position int, center double, scale double")


def _robust_sql_params():
    parts = [f"SELECT '{c}' AS feature, {i} AS position, quantile_cont({c}, 0.5) AS center, "
             f"CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1.0 "
             f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS scale FROM enriched"
             for i, c in enumerate(ALL_FEATURES)]
    return " UNION ALL ".join(parts)


def _standard_sql_params():
    parts = [f"SELECT '{c}' AS feature, {i} AS position, avg({c}) AS center, "
             f"CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS scale FROM enriched"
             for i, c in enumerate(ALL_FEATURES)]
    return " UNION ALL ".join(parts)


def _minmax_sql_params():
    parts = [f"SELECT '{c}' AS feature, {i} AS position, min({c}) AS center, "
             f"CASE WHEN max({c}) - min({c}) = 0 THEN 1.0 ELSE max({c}) - min({c}) END AS scale FROM enriched"
             for i, c in enumerate(ALL_FEATURES)]
    return " UNION ALL ".join(parts)


_PARAM_SQL = {"robust": _robust_sql_params, "standard": _standard_sql_params, "minmax": _minmax_sql_params}


def _params_query(kind):
    def q(spark, sf):
        return rounded(_params_frame(spark, FE.fit_scaler(enriched_sales(spark, sf), ALL_FEATURES, kind)), 6)
    return q


def _scaled_query(kind):
    def q(spark, sf):
        df = enriched_sales(spark, sf)
        params = FE.fit_scaler(df, ALL_FEATURES, kind)
        return rounded(FE.apply_scaler(df, params).select("o_orderkey", *ALL_FEATURES), 6)
    return q


for _kind in ("robust", "standard", "minmax"):
    register(f"scaler_params_{_kind}",
             f"{ENRICHED_SQL}, p AS ({_PARAM_SQL[_kind]()}) "
             f"SELECT feature, position, round(center, 6) AS center, round(scale, 6) AS scale FROM p")(
        _params_query(_kind))
    _cols = ", ".join(
        f"round(({c} - (SELECT center FROM p WHERE feature = '{c}')) / (SELECT scale FROM p WHERE feature = '{c}'), 6)"
        f" + 0.0 AS {c}" for c in ALL_FEATURES)
    register(f"scale_{_kind}", f"{ENRICHED_SQL}, p AS ({_PARAM_SQL[_kind]()}) SELECT o_orderkey, {_cols} FROM enriched")(
        _scaled_query(_kind))


LOG_COLS = ["sum_qty", "n_lines", "no_such_column"]


@register("log_replace", f"""{ENRICHED_SQL}
SELECT o_orderkey, round(ln(1 + sum_qty), 6) AS sum_qty, round(ln(1 + n_lines), 6) AS n_lines, round(avg_disc, 6) AS avg_disc FROM enriched""")
def q_log_replace(spark, sf):
    df = enriched_sales(spark, sf).select("o_orderkey", "sum_qty", "n_lines", "avg_disc")
    return rounded(FE.log_replace(df, LOG_COLS), 6)


def _log_append_sql():
    parts = [f"SELECT o_orderkey, '{c}_log' AS feature, round(ln(1 + {c}), 6) AS value FROM enriched "
             f"WHERE (SELECT count(*) = count({c}) AND min({c}) > 0 AND sum(CASE WHEN isnan({c}) THEN 1 ELSE 0 END) = 0"
             f" FROM enriched)" for c in ALL_FEATURES + ["price"]]
    return f"{ENRICHED_SQL} " + " UNION ALL ".join(parts)


@register("log_append", _log_append_sql())
def q_log_append(spark, sf):
    df = enriched_sales(spark, sf)
    cols = ALL_FEATURES + ["price"]
    chosen = FE.fit_log_append(df, cols)
    out = FE.apply_log_append(df.select("o_orderkey", *cols), chosen)
    logs = [f"{c}_log" for c in chosen]
    if not logs:
        return out.select("o_orderkey", F.lit(None).cast("string").alias("feature"),
                          F.lit(None).cast("double").alias("value")).limit(0)
    long = out.select("o_orderkey", F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").alias("value"))
                                                         for n in logs])).alias("s"))
    return rounded(long.select("o_orderkey", "s.feature", "s.value"), 6)


POLY_COLS = ["n_lines", "sum_qty", "avg_disc"]


def _poly_sql(degree, interaction_only, bias):
    exprs = []
    for name, combo in FE.poly_terms(POLY_COLS, degree, interaction_only, bias):
        e = " * ".join(combo) if combo else "1.0"
        exprs.append(f'round(CAST({e} AS DOUBLE), 6) + 0.0 AS "{name}"')
    return f"{ENRICHED_SQL} SELECT o_orderkey, {', '.join(exprs)} FROM enriched"


@register("poly2", _poly_sql(2, True, False))
def q_poly2(spark, sf):
    out = FE.polynomial(enriched_sales(spark, sf), POLY_COLS, 2, True, False, keep=["o_orderkey"])
    return rounded(out, 6)


@register("poly_full", _poly_sql(2, False, True))
def q_poly_full(spark, sf):
    out = FE.polynomial(enriched_sales(spark, sf), POLY_COLS, 2, False, True, keep=["o_orderkey"])
    return rounded(out, 6)


def _fscore_sql():
    complete = " AND ".join(f"{c} IS NOT NULL" for c in ALL_FEATURES + ["price"])
    parts = []
    for i, c in enumerate(ALL_FEATURES):
        r = f"(covar_pop({c}, price) / sqrt(var_pop({c}) * var_pop(price)))"
        parts.append(
            f"SELECT '{c}' AS feature, {i} AS position, CASE WHEN var_pop({c}) = 0 OR var_pop(price) = 0 THEN 0.0 "
            f"WHEN {r} * {r} >= 1 THEN 1.7976931348623157e308 "
            f"ELSE {r} * {r} / (1 - {r} * {r}) * (count(*) - 2) END AS f_score FROM c")
    return f"{ENRICHED_SQL}, c AS (SELECT * FROM enriched WHERE {complete}), f AS ({' UNION ALL '.join(parts)})"


@register("f_regression_scores", f"{_fscore_sql()} SELECT feature, position, round(f_score, 4) AS f_score FROM f")
def q_fscores(spark, sf):
    df = enriched_sales(spark, sf).dropna(subset=ALL_FEATURES + ["price"])
    return rounded(FE.f_scores(df, ALL_FEATURES, "price"), 4)


@register("select_k_best",
          f"{_fscore_sql()} SELECT feature, position FROM f ORDER BY f_score DESC, position DESC LIMIT 3")
def q_select_k_best(spark, sf):
    df = enriched_sales(spark, sf).dropna(subset=ALL_FEATURES + ["price"])
    names = FE.select_k_best(df, ALL_FEATURES, "price", 3)
    return spark.createDataFrame([(n, ALL_FEATURES.index(n)) for n in names], "feature string, position int")
