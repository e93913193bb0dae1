"""Scans, request validation, normalisation, dataset checks, outliers and
enrichment joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.operators import validate as V
from lathe.operators.enrich import dedup_lookup, enrich, join_missing_count, unmatched
from lathe.operators.outliers import IQR_PRESETS, remove_outliers, removed_stats
from lathe.operators.quantiles import quantiles
from lathe.operators.split import split
from lathe.plans import sqlparts as S
from lathe.plans.registry import register, rounded
from lathe.sources.requests import parse_json, requests_frame
from lathe.sources.tables import (LOOKUP_FEATURES, SALES_FEATURES, SALES_ID, SALES_KEY, lookup_frame, read_table,
                                  sales_frame, scan_head, scan_select, scan_typed_key)

# ------------------------------------------------------------------ sources
SCAN_COLS = ["l_extendedprice", "l_orderkey", "l_quantity", "l_partkey"]


@register("scan_select", f"SELECT {', '.join(SCAN_COLS)} FROM lineitem")
def q_scan_select(spark, sf):
    return scan_select(spark, f"{sf}/lineitem.parquet", SCAN_COLS)


@register("scan_typed_key", "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal FROM customer")
def q_scan_typed_key(spark, sf):
    return scan_typed_key(spark, f"{sf}/customer.parquet", ["c_acctbal", "c_nationkey", "c_custkey"], "c_nationkey")


@register("scan_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def q_scan_head(spark, sf):
    return scan_head(read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 100)


@register("parse_json_requests",
          "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
          "(json_valid(props) IS NOT TRUE OR json_type(props) <> 'OBJECT') AS parse_error FROM events")
def q_parse_json(spark, sf):
    parsed = parse_json(read_table(spark, sf, "events"), "props", "k INT", keep=["event_id"])
    return parsed.drop("absent_fields", "wrong_type_fields")


# ------------------------------------------------------------------ validation
REQ = f"WITH {S.requests_cte()}"
IDS = ", ".join(S.REQUEST_IDS)


@register("validate_rules", f"{REQ} SELECT {IDS}, {S.errors_sql(V.full_request_rules())} AS errors FROM requests "
          f"WHERE len({S.errors_sql(V.full_request_rules())}) > 0")
def q_validate_rules(spark, sf):
    _, rejected = V.validate(requests_frame(spark, sf), V.full_request_rules())
    return rejected.select(*S.REQUEST_IDS, "errors")


def _report_sql(rules):
    parts = []
    for i, r in enumerate(rules):
        parts.append(f"SELECT '{r['name']}' AS rule, {i} AS position, "
                     f"CAST(sum(CASE WHEN {S.rule_sql(r)} THEN 1 ELSE 0 END) AS BIGINT) AS violations, "
                     f"round(sum(CASE WHEN {S.rule_sql(r)} THEN 1 ELSE 0 END) / count(*), 6) AS share FROM requests")
    return f"{REQ} " + " UNION ALL ".join(parts)


@register("validation_report", _report_sql(V.full_request_rules()))
def q_validation_report(spark, sf):
    return rounded(V.validation_report(requests_frame(spark, sf), V.full_request_rules()), 6)


@register("validate_minimal", f"{REQ} SELECT {IDS}, {S.errors_sql(V.minimal_request_rules())} AS errors, "
          f"len({S.errors_sql(V.minimal_request_rules())}) = 0 AS valid FROM requests")
def q_validate_minimal(spark, sf):
    checked = V.with_errors(requests_frame(spark, sf), V.minimal_request_rules())
    return checked.select(*S.REQUEST_IDS, "errors", (F.size("errors") == 0).alias("valid"))


@register("key_format", f"{REQ} SELECT {IDS}, zipcode, regexp_matches(zipcode, '{V.KEY_REGEX}') AS key_ok "
          "FROM requests")
def q_key_format(spark, sf):
    return requests_frame(spark, sf).select(*S.REQUEST_IDS, "zipcode",
                                            F.col("zipcode").rlike(V.KEY_REGEX).alias("key_ok"))


@register("cross_field_rule", f"{REQ} SELECT {IDS}, yr_built, yr_renovated FROM requests "
          f"WHERE {S.rule_sql(V.renovation_rule())}")
def q_cross_field(spark, sf):
    _, rej = V.validate(requests_frame(spark, sf), [V.renovation_rule()])
    return rej.select(*S.REQUEST_IDS, "yr_built", "yr_renovated")


# ------------------------------------------------------------------ normalisation
@register("normalise_records",
          "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
          "CAST(trunc(l_quantity / 3) AS BIGINT) AS bedrooms, l_quantity / 4 AS floors, "
          "CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 5 THEN lpad(CAST(l_suppkey AS VARCHAR), 5, '0') "
          "ELSE CAST(l_suppkey AS VARCHAR) END AS zipcode FROM lineitem")
def q_normalise(spark, sf):
    li = read_table(spark, sf, "lineitem").select(
        *S.REQUEST_IDS, (F.col("l_quantity") / 3).alias("bedrooms"), (F.col("l_quantity") / 4).alias("floors"),
        F.col("l_suppkey").cast("double").alias("zipcode"))
    return V.normalise(li, int_cols=["bedrooms"], float_cols=["floors"], key="zipcode")


COERCE_SRC = ("CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(l_quantity AS STRING) END",
              "CASE WHEN l_linenumber = 5 THEN '' ELSE CAST(l_tax AS STRING) END")


@register("coerce_numeric",
          f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, TRY_CAST(q AS DOUBLE) AS q, "
          f"TRY_CAST(t AS DOUBLE) + 0.0 AS t, list_filter([CASE WHEN TRY_CAST(q AS DOUBLE) IS NULL THEN 'q' END, "
          f"CASE WHEN TRY_CAST(t AS DOUBLE) IS NULL THEN 't' END], lambda x: x IS NOT NULL) AS invalid_features "
          f"FROM (SELECT *, {COERCE_SRC[0]} AS q, {COERCE_SRC[1]} AS t FROM lineitem)")
def q_coerce(spark, sf):
    src = read_table(spark, sf, "lineitem").selectExpr(*S.REQUEST_IDS, f"{COERCE_SRC[0]} AS q", f"{COERCE_SRC[1]} AS t")
    out = V.coerce_numeric(src, ["q", "t"])
    return out.select(*S.REQUEST_IDS, "q", (F.col("t") + F.lit(0.0)).alias("t"), "invalid_features")


# bodies with some optional keys, explicit nulls, and none of them
DEFAULTS_JSON = ("CASE WHEN p_size % 4 = 0 THEN '{\"view\": 2, \"grade\": 9, \"waterfront\": 1}' "
                 "WHEN p_size % 4 = 1 THEN '{\"view\": null, \"yr_renovated\": null, \"sqft_basement\": 300}' "
                 "WHEN p_size % 4 = 2 THEN '{\"condition\": 5, \"waterfront\": null, \"yr_renovated\": 1999}' ELSE '{}' END")


def _defaults_sql():
    cols = ", ".join(f"CASE WHEN list_contains(json_keys(j), '{c}') THEN TRY_CAST(json_extract_string(j, '$.{c}') AS INTEGER) "
                     f"ELSE {v} END AS {c}" for c, v in V.REQUEST_DEFAULTS.items())
    return f"SELECT p_partkey, {cols} FROM (SELECT p_partkey, {DEFAULTS_JSON} AS j FROM part)"


@register("apply_defaults", _defaults_sql())
def q_apply_defaults(spark, sf):
    """All optional fields of a body: an absent key gets its default, an
    explicit null stays null."""
    bodies = read_table(spark, sf, "part").selectExpr("p_partkey", f"{DEFAULTS_JSON} AS j")
    parsed = parse_json(bodies, "j", ", ".join(f"`{c}` INT" for c in V.REQUEST_DEFAULTS), keep=["p_partkey"])
    out = V.apply_defaults(parsed, V.REQUEST_DEFAULTS, absent_col="absent_fields")
    return out.select("p_partkey", *[F.col(c).cast("int").alias(c) for c in V.REQUEST_DEFAULTS])


# ------------------------------------------------------------------ dataset checks
ENRICHED_SQL = f"""WITH {S.SALES}, {S.LOOKUP},
enriched AS (SELECT s.*, l.n_customers, l.avg_acctbal, l.min_acctbal, l.max_acctbal
             FROM sales s LEFT JOIN lookup l ON s.c_nationkey = l.lk)"""
ALL_FEATURES = SALES_FEATURES + LOOKUP_FEATURES


def enriched_sales(spark, sf):
    return enrich(sales_frame(spark, sf), lookup_frame(spark, sf), SALES_KEY)


def _checks_sql():
    cnt = lambda c: f"count({c})"
    allnull = ", ".join(f"CASE WHEN {cnt(c)} = 0 THEN '{c}' END" for c in ALL_FEATURES)
    infs = ", ".join(f"CASE WHEN sum(CASE WHEN isinf({c}) THEN 1 ELSE 0 END) > 0 THEN '{c}' END" for c in ALL_FEATURES)
    return f"""{ENRICHED_SQL},
a AS (SELECT count(*) AS n, count(price) AS ty, coalesce(sum(CASE WHEN isinf(price) THEN 1 ELSE 0 END), 0) AS tinf,
             list_filter([{allnull}], lambda x: x IS NOT NULL) AS allnull,
             list_filter([{infs}], lambda x: x IS NOT NULL) AS infs FROM enriched)
SELECT 'not_empty' AS "check", 0 AS position, n > 0 AS passed, 'rows=' || CAST(n AS VARCHAR) AS detail FROM a
UNION ALL SELECT 'no_all_null_columns', 1, len(allnull) = 0, array_to_string(allnull, ',') FROM a
UNION ALL SELECT 'target_not_all_null', 2, ty > 0, 'non_null=' || CAST(ty AS VARCHAR) FROM a
UNION ALL SELECT 'no_infinite_features', 3, len(infs) = 0, array_to_string(infs, ',') FROM a
UNION ALL SELECT 'no_infinite_target', 4, tinf = 0, 'infinite=' || CAST(tinf AS VARCHAR) FROM a"""


@register("validate_dataset", _checks_sql())
def q_validate_dataset(spark, sf):
    return V.check_dataset(enriched_sales(spark, sf), ALL_FEATURES, "price")


def _quality_sql():
    miss = " + ".join(f"sum(CASE WHEN {c} IS NULL OR isnan({c}) THEN 1 ELSE 0 END)" for c in ALL_FEATURES)
    k = len(ALL_FEATURES)
    return f"""{ENRICHED_SQL},
a AS (SELECT count(*) AS n_samples, ({miss}) AS miss, var_samp(price) AS target_variance FROM enriched)
SELECT n_samples, round(miss / (n_samples * {k}), 6) AS missing_ratio, round(target_variance, 0) AS target_variance,
       n_samples >= 100 AS enough_samples, coalesce(miss / (n_samples * {k}), 0) <= 0.5 AS missing_ok,
       coalesce(target_variance, 0) >= 1e-6 AS variance_ok,
       n_samples >= 100 AND coalesce(miss / (n_samples * {k}), 0) <= 0.5 AND coalesce(target_variance, 0) >= 1e-6
         AS passed FROM a"""


@register("quality_gate", _quality_sql())
def q_quality_gate(spark, sf):
    return rounded(V.quality_gate(enriched_sales(spark, sf), ALL_FEATURES, "price"), 6,
                   {"target_variance": 0})


# ------------------------------------------------------------------ outliers
def _iqr_sql(m):
    return f"""WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, b
WHERE value >= q1 - {m} * (q3 - q1) AND value <= q3 + {m} * (q3 - q1)"""


def _iqr_query(m):
    def q(spark, sf):
        return remove_outliers(read_table(spark, sf, "events").select("event_id", "value"), "value", m)
    return q


for _name, _m in IQR_PRESETS.items():
    register(f"{_name}_filter" if _name == "iqr" else f"{_name.replace('iqr_', 'iqr_filter_')}", _iqr_sql(_m))(
        _iqr_query(_m))


@register("iqr_removed_stats", f"""WITH kept AS ({_iqr_sql(1.5)})
SELECT (SELECT count(*) FROM events) AS initial_count, (SELECT count(*) FROM kept) AS final_count,
       (SELECT count(*) FROM events) - (SELECT count(*) FROM kept) AS removed_count,
       round(((SELECT count(*) FROM events) - (SELECT count(*) FROM kept)) * 100.0 / (SELECT count(*) FROM events), 6)
         AS removed_pct""")
def q_iqr_removed(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "value")
    return rounded(removed_stats(ev, remove_outliers(ev, "value", 1.5)), 6)


@register("quantiles", """SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q25,
  round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75
FROM events GROUP BY event_type""")
def q_quantiles(spark, sf):
    from lathe.operators.quantiles import grouped_quantiles

    ev = read_table(spark, sf, "events")
    return rounded(grouped_quantiles(ev, ["event_type"], "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"]), 6)


@register("quantiles_bucketed", """SELECT round(quantile_cont(l_extendedprice, 0.25), 6) AS q25,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.9), 6) AS q90
FROM lineitem""")
def q_quantiles_bucketed(spark, sf):
    li = read_table(spark, sf, "lineitem")
    q = quantiles(li, ["l_extendedprice"], [0.25, 0.5, 0.9], method="exact", buckets=64)["l_extendedprice"]
    return spark.createDataFrame([tuple(round(x, 6) for x in q)], "q25 double, q50 double, q75 double").toDF(
        "q25", "q50", "q90")


# ------------------------------------------------------------------ joins
ENRICH_COLS = ["o_orderkey", "price", *SALES_FEATURES, *LOOKUP_FEATURES]


@register("enrich_left", f"""{ENRICHED_SQL}
SELECT o_orderkey, price, {', '.join(f'round({c}, 6) AS {c}' for c in SALES_FEATURES)}, n_customers,
       round(avg_acctbal, 6) AS avg_acctbal, min_acctbal, max_acctbal FROM enriched""")
def q_enrich_left(spark, sf):
    out = enrich(sales_frame(spark, sf), lookup_frame(spark, sf), SALES_KEY, drop_key=True)
    return rounded(out.select(*ENRICH_COLS), 6, {"sum_qty": 6})


# Serving lookup: the supplier table as a per-nation lookup with several rows
# per key; first match (lowest s_suppkey) wins, lookup columns override.
@register("enrich_lookup", """WITH lk AS (
  SELECT s_nationkey, s_suppkey AS supplier, s_acctbal AS c_acctbal FROM (
    SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier) WHERE rn = 1)
SELECT c.c_custkey, c.c_nationkey, lk.supplier, lk.c_acctbal, lk.s_nationkey IS NOT NULL AS _matched
FROM customer c LEFT JOIN lk ON c.c_nationkey = lk.s_nationkey""")
def q_enrich_lookup(spark, sf):
    sup = read_table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_suppkey").alias("supplier"),
        F.col("s_acctbal").alias("c_acctbal"))
    first = dedup_lookup(sup, "c_nationkey", [F.col("supplier")])
    cust = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    out = enrich(cust, first, "c_nationkey", flag=True)
    return out.select("c_custkey", "c_nationkey", "supplier", "c_acctbal", "_matched")


@register("unmatched_keys", f"""WITH {S.requests_cte()}, zl AS ({S.ZIP_LOOKUP})
SELECT {IDS}, zipcode FROM requests r WHERE NOT EXISTS (SELECT 1 FROM zl WHERE zl.zipcode = r.zipcode)""")
def q_unmatched(spark, sf):
    zl = read_table(spark, sf, "supplier").selectExpr(
        "CAST(97990 + s_suppkey AS STRING) AS zipcode", "s_acctbal").filter("s_acctbal > 0")
    return unmatched(requests_frame(spark, sf).select(*S.REQUEST_IDS, "zipcode"), zl, "zipcode")


_REQ_COLS = [a for _, a in S.REQUEST_FIELDS]


def _nulls_sql(cols, src):
    return " + ".join(f'count(*) - count("{c}")' for c in cols) + f" FROM {src}"


@register("join_missing_count", f"""WITH {S.requests_cte()}, zl AS ({S.ZIP_LOOKUP}),
j AS (SELECT r.*, zl.zip_acctbal, zl.zip_nation FROM requests r LEFT JOIN zl ON r.zipcode = zl.zipcode)
SELECT CAST((SELECT {_nulls_sql(_REQ_COLS, 'requests')}) AS BIGINT) AS nulls_before,
       CAST((SELECT {_nulls_sql(_REQ_COLS + ['zip_acctbal', 'zip_nation'], 'j')}) AS BIGINT) AS nulls_after,
       CAST((SELECT {_nulls_sql(_REQ_COLS + ['zip_acctbal', 'zip_nation'], 'j')})
            - (SELECT {_nulls_sql(_REQ_COLS, 'requests')}) AS BIGINT) AS missing_added""")
def q_join_missing(spark, sf):
    """Requests enriched with the key lookup (which lacks suppliers with a
    non-positive balance): NULLs the join adds."""
    req = requests_frame(spark, sf).select(*_REQ_COLS)
    zl = read_table(spark, sf, "supplier").selectExpr(
        "CAST(97990 + s_suppkey AS STRING) AS zipcode", "s_acctbal AS zip_acctbal", "s_nationkey AS zip_nation",
        "s_acctbal").filter("s_acctbal > 0").drop("s_acctbal")
    after = enrich(req, zl, "zipcode")
    return join_missing_count(req, after, _REQ_COLS + ["zip_acctbal", "zip_nation"])


# ------------------------------------------------------------------ info
@register("dataset_info", f"""{ENRICHED_SQL}
SELECT count(*) AS dataset_size, {len(ALL_FEATURES)} AS n_features, round(avg(price), 4) AS target_mean,
       round(stddev_samp(price), 4) AS target_std, min(price) AS target_min, max(price) AS target_max,
       CAST({' + '.join(f'count(*) FILTER (WHERE {c} IS NULL OR isnan({c}))' for c in ALL_FEATURES)} AS BIGINT)
         AS missing_values,
       CAST(count(*) FILTER (WHERE price IS NULL OR isnan(price)) AS BIGINT) AS target_missing FROM enriched""")
def q_dataset_info(spark, sf):
    df = enriched_sales(spark, sf)
    from lathe.functions.columns import missing

    miss = sum((F.count(F.when(missing(c), 1)) for c in ALL_FEATURES), F.lit(0))
    out = df.agg(F.count(F.lit(1)).alias("dataset_size"), F.lit(len(ALL_FEATURES)).alias("n_features"),
                 F.avg("price").alias("target_mean"), F.stddev_samp("price").alias("target_std"),
                 F.min("price").alias("target_min"), F.max("price").alias("target_max"),
                 miss.cast("long").alias("missing_values"),
                 F.count(F.when(missing("price"), 1)).cast("long").alias("target_missing"))
    return rounded(out, 4, {"target_min": 6, "target_max": 6})


@register("processing_info", f"""{ENRICHED_SQL},
b AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM enriched),
kept AS (SELECT e.* FROM enriched e, b WHERE price >= q1 - 1.5 * (q3 - q1) AND price <= q3 + 1.5 * (q3 - q1)),
{S.split('kept', 'o_orderkey')}
SELECT (SELECT count(*) FROM enriched) AS initial_rows, (SELECT count(*) FROM kept) AS after_outliers,
       (SELECT count(*) FROM enriched) - (SELECT count(*) FROM kept) AS samples_removed,
       (SELECT count(*) FROM splitted WHERE split = 'train') AS train_rows,
       (SELECT count(*) FROM splitted WHERE split = 'test') AS test_rows,
       {len(ALL_FEATURES)} AS n_features,
       (SELECT CAST({' + '.join(f"CASE WHEN count({c}) = count(*) AND min({c}) > 0 THEN 1 ELSE 0 END" for c in ALL_FEATURES)}
        AS INTEGER) FROM kept) AS features_added""")
def q_processing_info(spark, sf):
    df = enriched_sales(spark, sf)
    kept = remove_outliers(df, "price", 1.5)
    s = split(kept, [SALES_ID], 0.2, 42)
    both = df.select(F.lit(None).cast("string").alias("split")).unionByName(s.select("split"))
    b = both.agg(F.count(F.when(F.col("split").isNull(), 1)).alias("initial_rows"),
                 F.count("split").alias("after_outliers"),
                 F.count(F.when(F.col("split") == "train", 1)).alias("train_rows"),
                 F.count(F.when(F.col("split") == "test", 1)).alias("test_rows"))
    # feature engineering "log_transform" appends a log column per all-positive feature
    from lathe.operators.features import fit_log_append

    added = len(fit_log_append(kept, ALL_FEATURES))
    return b.select("initial_rows", "after_outliers",
                    (F.col("initial_rows") - F.col("after_outliers")).alias("samples_removed"),
                    "train_rows", "test_rows", F.lit(len(ALL_FEATURES)).alias("n_features"),
                    F.lit(added).alias("features_added"))
