"""Feature engineering: scalers, log transforms, polynomial products,
univariate F scores and k-best selection.

Fitting is one aggregate over all columns; fitted parameters are a tiny
driver-side dict (two numbers per column), applied as literals so the
transform stays inside whole-stage codegen.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.functions.columns import missing
from lathe.operators.quantiles import quantiles

# Fixed value: distance between the 25th and 75th percentiles of the
# standard normal distribution (RobustScaler ``unit_variance``).
NORMAL_IQR = 1.3489795003921634


def _present(c: str):
    """The value as double, NULL where it is missing (NULL or NaN)."""
    x = F.col(c).cast("double")
    return F.when(~missing(x), x)


def fit_scaler(df: DataFrame, cols: list[str], kind: str = "robust", with_centering: bool = True,
               with_scaling: bool = True, quantile_range: tuple = (25.0, 75.0), unit_variance: bool = False,
               feature_range: tuple = (0.0, 1.0), quantile_method: str = "exact") -> dict:
    """Fit ``robust`` (median, IQR), ``standard`` (mean, population std) or
    ``minmax`` scaling. Returns ``{"kind", "center": {c: v}, "scale": {c: v}}``
    with the transform ``(x − center) / scale``; a zero scale becomes 1."""
    center, scale = {}, {}
    if kind == "robust":
        lo, hi = quantile_range
        qv = quantiles(df, cols, [0.5, lo / 100.0, hi / 100.0], quantile_method)
        for c in cols:
            med, q_lo, q_hi = qv[c]
            center[c] = med if with_centering else 0.0
            s = (q_hi - q_lo) if with_scaling and q_hi is not None else 1.0
            if unit_variance and with_scaling:
                from statistics import NormalDist

                nd = NormalDist()
                s = s / (NORMAL_IQR if (lo, hi) == (25.0, 75.0) else nd.inv_cdf(hi / 100.0) - nd.inv_cdf(lo / 100.0))
            scale[c] = 1.0 if (s == 0 or s is None) else s
    elif kind == "standard":
        row = df.agg(*[F.avg(_present(c)).alias(f"m_{c}") for c in cols],
                     *[F.stddev_pop(_present(c)).alias(f"s_{c}") for c in cols]).first()
        for c in cols:
            center[c] = row[f"m_{c}"] if with_centering else 0.0
            s = row[f"s_{c}"] if with_scaling else 1.0
            scale[c] = 1.0 if (s is None or s == 0) else s
    elif kind == "minmax":
        fmin, fmax = feature_range
        row = df.agg(*[F.min(_present(c)).alias(f"lo_{c}") for c in cols],
                     *[F.max(_present(c)).alias(f"hi_{c}") for c in cols]).first()
        for c in cols:
            lo_v, hi_v = row[f"lo_{c}"], row[f"hi_{c}"]
            rng = (hi_v - lo_v) if lo_v is not None else 1.0
            rng = 1.0 if rng == 0 else rng
            # x' = (x − lo)/rng·(fmax − fmin) + fmin  ==  (x − center)/scale
            s = rng / (fmax - fmin)
            center[c] = lo_v - fmin * s if lo_v is not None else 0.0
            scale[c] = s
    else:
        raise ValueError(f"unknown scaler {kind}")
    return {"kind": kind, "center": center, "scale": scale}


def apply_scaler(df: DataFrame, params: dict, suffix: str = "") -> DataFrame:
    """Replace (or, with ``suffix``, add) each fitted column by its scaled value."""
    out = df
    for c, ctr in params["center"].items():
        out = out.withColumn(f"{c}{suffix}", (F.col(c).cast("double") - F.lit(ctr)) / F.lit(params["scale"][c]))
    return out


def _log1p_np(c: str):
    """numpy ``log1p``: −inf at −1, NaN below (Spark's ``log1p`` gives NULL)."""
    x = F.col(c).cast("double")
    return (F.when(x == -1.0, F.lit(float("-inf")))
            .when(x < -1.0, F.lit(float("nan")))
            .otherwise(F.log1p(x)))


def log_replace(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace named columns by log1p; unknown names are skipped."""
    out = df
    for c in cols:
        if c in df.columns:
            out = out.withColumn(c, _log1p_np(c))
    return out


def fit_log_append(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns whose values are all > 0 with nothing missing (one aggregate)."""
    row = df.agg(*[F.min(F.when(missing(c) | (F.col(c) <= 0), F.lit(0)).otherwise(F.lit(1))).alias(c)
                   for c in cols]).first()
    return [c for c in cols if row[c] == 1]


def apply_log_append(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select("*", *[_log1p_np(c).alias(f"{c}_log") for c in cols])


def poly_terms(cols: list[str], degree: int = 2, interaction_only: bool = True,
               include_bias: bool = False) -> list[tuple[str, tuple[str, ...]]]:
    """(name, factors) of every output term, in scikit-learn order and naming
    ("a b" for products, "a^2" for powers, "1" for the bias)."""
    terms = [("1", ())] if include_bias else []
    for d in range(1, degree + 1):
        combos = (itertools.combinations(cols, d) if interaction_only
                  else itertools.combinations_with_replacement(cols, d))
        for combo in combos:
            parts = []
            for c, grp in itertools.groupby(combo):
                k = len(list(grp))
                parts.append(c if k == 1 else f"{c}^{k}")
            terms.append((" ".join(parts), combo))
    return terms


def polynomial(df: DataFrame, cols: list[str], degree: int = 2, interaction_only: bool = True,
               include_bias: bool = False, keep: list[str] | tuple = (), as_array: str | None = None) -> DataFrame:
    """Polynomial features as native products, one column per term. With
    ``as_array`` all terms are one ``array<double>`` column in the order of
    ``poly_terms``: a product over positions, whose plan holds one expression
    whatever the number of terms (33 columns make 561). A NULL or NaN factor
    makes its terms NULL or NaN."""
    terms = poly_terms(cols, degree, interaction_only, include_bias)
    if as_array:
        at = {c: i for i, c in enumerate(cols)}
        places = F.array(*[F.array(*[F.lit(at[c]) for c in combo]).cast("array<int>") for _, combo in terms])
        whole = F.array(F.array(*[F.col(c).cast("double") for c in cols]))  # one element, so that it is computed once
        products = F.transform(whole, lambda x: F.transform(places, lambda term: F.aggregate(
            term, F.lit(1.0), lambda product, i: product * F.get(x, i))))
        return df.select(*keep, F.get(products, F.lit(0)).alias(as_array))
    exprs = []
    for name, combo in terms:
        e = F.lit(1.0)
        for c in combo:
            e = e * F.col(c).cast("double")
        exprs.append(e.alias(name))
    return df.select(*keep, *exprs)


# Fixed value: largest finite float64 (F score of a perfectly correlated feature).
FLOAT64_MAX = 1.7976931348623157e308


def f_scores(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """Univariate F statistic per feature: r²/(1−r²)·(n−2) with centred
    moments (``covar_pop``, ``var_pop``), in one aggregate. A constant feature
    scores 0; |r| = 1 scores the largest finite double. Returns rows
    ``feature, position, f_score``."""
    y = F.col(target).cast("double")
    aggs = [F.count(F.lit(1)).alias("_n"), F.var_pop(y).alias("_vy")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.covar_pop(x, y).alias(f"_c{i}"), F.var_pop(x).alias(f"_v{i}")]
    row = df.agg(*aggs)
    stack = []
    for i, c in enumerate(cols):
        r = F.try_divide(F.col(f"_c{i}"), F.sqrt(F.col(f"_v{i}") * F.col("_vy")))
        r2 = r * r
        score = (F.when(r.isNull() | F.isnan(r), F.lit(0.0))
                 .when(r2 >= 1.0, F.lit(FLOAT64_MAX))
                 .otherwise(r2 / (F.lit(1.0) - r2) * (F.col("_n") - 2)))
        stack.append(F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"), score.alias("f_score")))
    return row.select(F.explode(F.array(*stack)).alias("s")).select("s.*")


def select_k_best(df: DataFrame, cols: list[str], target: str, k: int) -> list[str]:
    """Names of the ``k`` highest F scores, ties to the later column, kept in
    the original column order. k ≥ number of columns keeps all."""
    if k >= len(cols):
        return list(cols)
    best = (f_scores(df, cols, target).orderBy(F.desc("f_score"), F.desc("position")).limit(k)
            .select("position").collect())
    chosen = {r["position"] for r in best}
    return [c for i, c in enumerate(cols) if i in chosen]
