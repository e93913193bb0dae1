"""Declarative record validation, normalisation and dataset checks.

A rule table is a list of dicts; ``validate`` turns it into one projection
that adds ``errors array<string>`` (names of the violated rules), so the
whole table is checked in a single pass inside codegen, and the result is
split into valid rows and a dead letter.

Rule kinds (``kind``):
  ``required``  value present (not NULL/NaN and not empty text)
  ``range``     lo <= numeric value <= hi (closed); absent values pass
  ``integer``   the value is integral ("4", 4.0 pass, 4.5 fails)
  ``pattern``   text matches the regular expression ``regex``
  ``expr``      a Column (or SQL text) that is TRUE when the rule is broken;
                ``numeric``: the same where all of ``cols`` are float or double
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.functions.columns import missing


NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def num(c: str, dtype: str | None = None) -> Column:
    """Number → double; text → ``try_cast`` to double (bad text → NULL, and
    '4.0' is accepted where an int cast would fail)."""
    if dtype is not None and dtype.startswith(NUMERIC):
        return F.col(c).cast("double")
    return F.expr(f"try_cast(cast(`{c}` as string) as double)")


def _present(c: str, dtype: str | None = None) -> Column:
    v = F.col(c)
    if dtype is not None and dtype.startswith(NUMERIC):
        return v.isNotNull() & ~F.isnan(num(c, dtype))
    return v.isNotNull() & (F.trim(v.cast("string")) != "") & ~F.coalesce(F.isnan(num(c, dtype)), F.lit(False))


def _broken_numeric(kind: str, c: str, rule: dict, dtype: str) -> Column:
    """Lean predicates for numeric columns (no text parsing). Spark orders NaN
    above every number, so ``NOT (lo <= x <= hi)`` also flags NaN."""
    x = F.col(c).cast("double")
    if kind == "required":
        return F.col(c).isNull() | F.isnan(x)
    if kind == "range":
        return F.coalesce(~((x >= F.lit(rule["lo"])) & (x <= F.lit(rule["hi"]))), F.lit(False))
    if kind == "integer":
        if not dtype.startswith(("float", "double", "decimal")):
            return F.lit(False)
        return F.coalesce(x != F.floor(x), F.lit(False))
    return None


def _broken(rule: dict, types: dict | None = None) -> Column:
    kind, c = rule["kind"], rule.get("col")
    dtype = (types or {}).get(c)
    if dtype is not None and dtype.startswith(NUMERIC) and kind in ("required", "range", "integer"):
        return _broken_numeric(kind, c, rule, dtype)
    if kind == "required":
        return ~_present(c, dtype)
    if kind == "range":
        x = num(c, dtype)
        bad = x.isNull() | F.isnan(x) | (x < F.lit(rule["lo"])) | (x > F.lit(rule["hi"]))
        return F.col(c).isNotNull() & bad
    if kind == "integer":
        x = num(c, dtype)
        return F.col(c).isNotNull() & (x.isNull() | (x != F.floor(x)))
    if kind == "pattern":
        return F.col(c).isNotNull() & ~F.col(c).cast("string").rlike(rule["regex"])
    if kind == "expr":
        numeric = "numeric" in rule and all((types or {}).get(x) in ("float", "double") for x in rule["cols"])
        e = rule["numeric"] if numeric else rule["expr"]
        return F.coalesce(F.expr(e) if isinstance(e, str) else e, F.lit(False))
    raise ValueError(f"unknown rule kind {kind}")


def rule_violations(rules: list[dict], types: dict | None = None) -> Column:
    """``array<string>`` of broken rule names, in rule-table order;
    ``types`` (column → Spark type name) lets numeric columns skip text
    parsing."""
    flags = [F.when(_broken(r, types), F.lit(r["name"])) for r in rules]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def is_valid(rules: list[dict], types: dict | None = None) -> Column:
    """TRUE when no rule is broken: one boolean expression, no names built.

    Dozens of rules over computed fields make a method longer than Java
    compiles (8000 bytes of bytecode), which then runs interpreted, several
    times slower. A lambda, here one that is always true, keeps the operator
    out of whole-stage code: its rules become many short methods instead."""
    if not rules:
        return F.lit(True)
    valid = ~functools.reduce(lambda a, b: a | b, [_broken(r, types) for r in rules])
    at = next((r["col"] for r in rules if r.get("col") in (types or {})), None)
    return valid & F.forall(F.array(at), lambda _: F.lit(True)) if at else valid


def validate(df: DataFrame, rules: list[dict], errors_col: str = "errors") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); ``rejected`` keeps every input column plus
    ``errors``. Validity is a plain boolean predicate; the error names are
    only built for rejected rows."""
    types = dict(df.dtypes)
    valid = df.filter(is_valid(rules, types))
    rejected = df.filter(~is_valid(rules, types)).withColumn(errors_col, rule_violations(rules, types))
    return valid, rejected


def with_errors(df: DataFrame, rules: list[dict], errors_col: str = "errors", valid_col: str | None = None) -> DataFrame:
    """Add ``errors`` (empty for valid rows; the array of broken rule names is
    only built when a rule is broken) and optionally a ``valid`` flag."""
    types = dict(df.dtypes)
    ok = is_valid(rules, types)
    out = df.withColumn(valid_col or "_valid_tmp", ok)
    flag = F.col(valid_col or "_valid_tmp")
    out = out.withColumn(errors_col, F.when(flag, F.array().cast("array<string>"))
                         .otherwise(rule_violations(rules, types)))
    return out if valid_col else out.drop("_valid_tmp")


def validation_report(df: DataFrame, rules: list[dict]) -> DataFrame:
    """Per rule: violations and share of rows, in one aggregate."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    types = dict(df.dtypes)
    aggs += [F.sum(F.when(_broken(r, types), 1).otherwise(0)).alias(f"_r{i}") for i, r in enumerate(rules)]
    row = df.agg(*aggs)
    stack = [F.struct(F.lit(r["name"]).alias("rule"), F.lit(i).alias("position"),
                      F.coalesce(F.col(f"_r{i}"), F.lit(0)).cast("long").alias("violations"),
                      F.try_divide(F.coalesce(F.col(f"_r{i}"), F.lit(0)).cast("double"), F.col("_n")).alias("share"))
             for i, r in enumerate(rules)]
    return row.select(F.explode(F.array(*stack)).alias("s")).select("s.*")


# ----------------------------------------------------------------- request rules
def _range_rules(spec: list[tuple]) -> list[dict]:
    rules = []
    for col, lo, hi, integer, required in spec:
        if required:
            rules.append({"name": f"{col}_required", "kind": "required", "col": col})
        if integer:
            rules.append({"name": f"{col}_integer", "kind": "integer", "col": col})
        rules.append({"name": f"{col}_range", "kind": "range", "col": col, "lo": lo, "hi": hi})
    return rules


# The full request's fields — (name, min, max, integer, required).
FULL_REQUEST_FIELDS = [
    ("bedrooms", 0, 20, True, True),
    ("bathrooms", 0, 10, False, True),
    ("sqft_living", 100, 20000, True, True),
    ("sqft_lot", 500, 1000000, True, True),
    ("floors", 1, 5, False, True),
    ("waterfront", 0, 1, True, False),
    ("view", 0, 4, True, False),
    ("condition", 1, 5, True, False),
    ("grade", 1, 13, True, False),
    ("sqft_above", 100, 20000, True, True),
    ("sqft_basement", 0, 10000, True, False),
    ("yr_built", 1900, 2025, True, True),
    ("yr_renovated", 0, 2025, True, False),
    ("lat", 47.0, 48.0, False, True),
    ("long", -123.0, -121.0, False, True),
    ("sqft_living15", 100, 20000, True, False),
    ("sqft_lot15", 500, 1000000, True, False),
]
# The minimal request's fields.
MINIMAL_REQUEST_FIELDS = [
    ("bedrooms", 0, 20, True, True),
    ("bathrooms", 0, 10, False, True),
    ("sqft_living", 100, 20000, True, True),
    ("sqft_lot", 500, 1000000, True, True),
    ("floors", 1, 5, False, True),
    ("sqft_above", 100, 20000, True, True),
    ("sqft_basement", 0, 10000, True, False),
]
# Defaults of absent optional fields.
REQUEST_DEFAULTS = {"waterfront": 0, "view": 0, "condition": 3, "grade": 7, "sqft_basement": 0, "yr_renovated": 0}
# Fixed value: key format, exactly five digits.
KEY_REGEX = "^[0-9]{5}$"


def key_rules(col: str = "zipcode") -> list[dict]:
    return [{"name": f"{col}_required", "kind": "required", "col": col},
            {"name": f"{col}_format", "kind": "pattern", "col": col, "regex": KEY_REGEX}]


def renovation_rule(built: str = "yr_built", renovated: str = "yr_renovated") -> dict:
    """If renovated > 0 it must be >= built; skipped when built is itself
    invalid or absent. ``expr`` is Spark SQL, ``sql`` the DuckDB oracle."""
    def broken(b: str, r: str) -> str:
        return f"{b} IS NOT NULL AND {b} >= 1900 AND {b} <= 2025 AND {b} = floor({b}) AND {r} > 0 AND {r} < {b}"

    expr = broken(*(f"try_cast(cast(`{c}` as string) as double)" for c in (built, renovated)))
    numeric = broken(*(f"cast(`{c}` as double)" for c in (built, renovated)))
    sql = (f"{built} IS NOT NULL AND {built} >= 1900 AND {built} <= 2025 AND {built} = floor({built}) "
           f"AND {renovated} > 0 AND {renovated} < {built}")
    return {"name": "renovation_before_built", "kind": "expr", "expr": expr, "sql": sql, "numeric": numeric,
            "cols": [built, renovated]}


def malformed_rule(flag_col: str = "parse_error") -> dict:
    """A body that did not parse as a JSON object (see ``parse_json``)."""
    return {"name": "malformed_json", "kind": "expr", "expr": f"`{flag_col}`", "sql": flag_col}


def wrong_type_rule(col: str = "wrong_type_fields") -> dict:
    """A field whose JSON value has another type (see ``parse_json``)."""
    return {"name": "wrong_type", "kind": "expr", "expr": f"size(`{col}`) > 0", "sql": "false"}


def full_request_rules() -> list[dict]:
    return _range_rules(FULL_REQUEST_FIELDS) + key_rules() + [renovation_rule()]


def minimal_request_rules() -> list[dict]:
    return _range_rules(MINIMAL_REQUEST_FIELDS) + key_rules()


# ----------------------------------------------------------------- normalisation
def normalise(df: DataFrame, int_cols: list[str] = (), float_cols: list[str] = (), key: str | None = None,
              key_width: int = 5) -> DataFrame:
    """``int(float(x))`` truncation for ``int_cols``, ``float(x)`` for
    ``float_cols``; the key becomes ``str(int(float(k)))`` left-padded with
    zeros to ``key_width`` (longer keys are kept whole, never cut)."""
    out = df
    for c in int_cols:
        out = out.withColumn(c, num(c).cast("long"))
    for c in float_cols:
        out = out.withColumn(c, num(c))
    if key:
        k = num(key).cast("long").cast("string")
        out = out.withColumn(key, F.when(F.length(k) < key_width, F.lpad(k, key_width, "0")).otherwise(k))
    return out


def coerce_numeric(df: DataFrame, cols: list[str], flag_col: str = "invalid_features") -> DataFrame:
    """Cast ``cols`` to double; ``invalid_features`` lists, in order, the
    columns whose value is missing or not a number."""
    types = dict(df.dtypes)
    out = df.select(*[c for c in df.columns if c not in cols], *[num(c, types.get(c)).alias(c) for c in cols])
    flags = F.filter(F.array(*[F.when(missing(c), F.lit(c)) for c in cols]), lambda x: x.isNotNull())
    return out.withColumn(flag_col, flags)


def apply_defaults(df: DataFrame, defaults: dict, json_col: str | None = None, absent_col: str | None = None) -> DataFrame:
    """Fill absent optional fields. For JSON input only keys absent from the
    object are filled, told by its text (``json_col``) or by the names that
    parsing found absent (``absent_col``): an explicit ``null`` stays NULL. For
    table rows a NULL is filled."""
    types = dict(df.dtypes)
    filled = {}
    for c, v in defaults.items():
        value = F.lit(v).cast(types[c]) if types[c] == "string" else F.lit(v)
        if absent_col:
            filled[c] = F.when(F.coalesce(F.array_contains(absent_col, c), F.lit(False)), value).otherwise(F.col(c))
        elif json_col:
            has_key = F.array_contains(F.json_object_keys(F.col(json_col)), c)
            filled[c] = F.when(F.coalesce(has_key, F.lit(False)), F.col(c)).otherwise(value)
        else:
            filled[c] = F.coalesce(F.col(c), value)
    return df.withColumns(filled) if filled else df


# ----------------------------------------------------------------- dataset checks
# Dataset quality thresholds.
QUALITY_THRESHOLDS = {"min_samples": 100, "max_missing_ratio": 0.5, "min_target_variance": 1e-6}


def check_dataset(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """One aggregate → rows ``check, position, passed, detail`` in the
    reference's order: empty, feature columns without a value (NULL or NaN
    throughout), target without a value, infinite features, infinite target. (Features and target live in one
    frame, so a length mismatch cannot occur.)"""
    inf = [F.lit(float("inf")), F.lit(float("-inf"))]
    aggs = [F.count(F.lit(1)).alias("_n"),
            F.count(F.when(~missing(F.col(target).cast("double")), 1)).alias("_ty"),
            F.sum(F.when(F.col(target).cast("double").isin(*inf), 1).otherwise(0)).alias("_tinf")]
    for i, c in enumerate(features):
        aggs.append(F.count(F.when(~missing(F.col(c).cast("double")), 1)).alias(f"_c{i}"))
        aggs.append(F.sum(F.when(F.col(c).cast("double").isin(*inf), 1).otherwise(0)).alias(f"_i{i}"))
    row = df.agg(*aggs)
    allnull = F.filter(F.array(*[F.when(F.col(f"_c{i}") == 0, F.lit(c)) for i, c in enumerate(features)]),
                       lambda x: x.isNotNull())
    infs = F.filter(F.array(*[F.when(F.col(f"_i{i}") > 0, F.lit(c)) for i, c in enumerate(features)]),
                    lambda x: x.isNotNull())
    checks = [
        ("not_empty", F.col("_n") > 0, F.concat(F.lit("rows="), F.col("_n").cast("string"))),
        ("no_all_null_columns", F.size(allnull) == 0, F.array_join(allnull, ",")),
        ("target_not_all_null", F.col("_ty") > 0, F.concat(F.lit("non_null="), F.col("_ty").cast("string"))),
        ("no_infinite_features", F.size(infs) == 0, F.array_join(infs, ",")),
        ("no_infinite_target", F.coalesce(F.col("_tinf"), F.lit(0)) == 0,
         F.concat(F.lit("infinite="), F.coalesce(F.col("_tinf"), F.lit(0)).cast("string"))),
    ]
    stack = [F.struct(F.lit(n).alias("check"), F.lit(i).alias("position"), p.alias("passed"), d.alias("detail"))
             for i, (n, p, d) in enumerate(checks)]
    return row.select(F.explode(F.array(*stack)).alias("s")).select("s.*")


def raise_on_failure(checks: DataFrame) -> None:
    """Raise ``ValueError`` for the first failing check (driver reads ≤ 5 rows)."""
    bad = checks.filter(~F.col("passed")).orderBy("position").limit(1).collect()
    if bad:
        raise ValueError(f"Data validation failed: {bad[0]['check']} ({bad[0]['detail']})")


def quality_gate(df: DataFrame, features: list[str], target: str, thresholds: dict | None = None) -> DataFrame:
    """Sample count, overall missing ratio of the features and target
    variance (sample) against thresholds, in one aggregate."""
    t = dict(QUALITY_THRESHOLDS, **(thresholds or {}))
    miss = sum((F.sum(F.when(missing(c), 1).otherwise(0)) for c in features), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n_samples"), miss.alias("_miss"),
                 F.var_samp(F.col(target).cast("double")).alias("target_variance"))
    return row.select(
        "n_samples",
        F.try_divide(F.col("_miss").cast("double"), F.col("n_samples") * F.lit(len(features))).alias("missing_ratio"),
        "target_variance",
        (F.col("n_samples") >= t["min_samples"]).alias("enough_samples"),
        (F.coalesce(F.try_divide(F.col("_miss").cast("double"), F.col("n_samples") * F.lit(len(features))),
                    F.lit(0.0)) <= t["max_missing_ratio"]).alias("missing_ok"),
        (F.coalesce(F.col("target_variance"), F.lit(0.0)) >= t["min_target_variance"]).alias("variance_ok"),
    ).withColumn("passed", F.col("enough_samples") & F.col("missing_ok") & F.col("variance_ok"))
