"""Shared SQL building blocks (DuckDB dialect) for the oracles; each mirrors
a Spark binding in ``lathe.sources.tables`` or an operator."""

SALES = """
li AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS sum_qty,
         avg(l_discount) + 0.0 AS avg_disc, avg(l_tax) + 0.0 AS avg_tax
  FROM lineitem GROUP BY l_orderkey),
sales AS (
  SELECT o.o_orderkey, o.o_totalprice AS price, c.c_nationkey, c.c_mktsegment, o.o_orderpriority,
         o.o_orderdate, li.n_lines, li.sum_qty, li.avg_disc, li.avg_tax
  FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey)"""

LOOKUP = """
lookup AS (
  SELECT c_nationkey AS lk, CAST(count(*) AS DOUBLE) AS n_customers, avg(c_acctbal) AS avg_acctbal,
         min(c_acctbal) AS min_acctbal, max(c_acctbal) AS max_acctbal
  FROM customer GROUP BY c_nationkey)"""


def split(src: str, id_col: str, test_size: float = 0.2, seed: int = 42, name: str = "splitted") -> str:
    return f"""
{name} AS (
  SELECT *, CASE WHEN rk <= ceil(CAST({test_size} AS DOUBLE) * n_all) THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY md5('{seed}|' || CAST({id_col} AS VARCHAR)), {id_col}) AS rk,
               count(*) OVER () AS n_all FROM {src}))"""


def metric_select(y: str, yhat: str) -> str:
    """Aggregate expressions for n, mae, mse, rmse, r2, mape, wmape."""
    e = f"({yhat} - {y})"
    return f"""count(*) AS n,
  sum(abs({e})) / count(*) AS mae,
  sum({e} * {e}) / count(*) AS mse,
  sqrt(sum({e} * {e}) / count(*)) AS rmse,
  CASE WHEN var_pop({y}) * count(*) = 0 THEN (CASE WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END)
       ELSE 1.0 - sum({e} * {e}) / (var_pop({y}) * count(*)) END AS r2,
  100.0 * avg(abs({e}) / greatest(abs({y}), 2.220446049250313e-16)) AS mape,
  100.0 * sum(abs({e})) / nullif(sum(abs({y})), 0) AS wmape"""


# Request records derived from lineitem: every field of the full request,
# with values that break each rule on some rows. Shared by Spark
# (``selectExpr``) and DuckDB; (expression, name) pairs.
REQUEST_FIELDS = [
    ("CASE WHEN l_quantity = 49 THEN 4.5 WHEN l_quantity = 50 THEN 25.0 "
     "ELSE CAST(CAST(l_quantity AS BIGINT) % 21 AS DOUBLE) END", "bedrooms"),
    ("l_quantity / 5", "bathrooms"),
    ("CAST(floor(100 + l_extendedprice / 6) AS DOUBLE)", "sqft_living"),
    ("CAST(500 + l_partkey * 10 AS DOUBLE)", "sqft_lot"),
    ("CASE WHEN l_linenumber = 7 AND l_quantity > 40 THEN 6.0 ELSE CAST(1 + l_linenumber % 3 AS DOUBLE) END", "floors"),
    ("CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE CAST(l_suppkey % 2 AS DOUBLE) END", "waterfront"),
    ("CAST(l_suppkey % 5 AS DOUBLE)", "view"),
    ("CAST(1 + l_linenumber % 5 AS DOUBLE)", "condition"),
    ("CAST(CAST(l_quantity AS BIGINT) % 14 AS DOUBLE)", "grade"),
    ("CAST(floor(100 + l_extendedprice / 6) AS DOUBLE)", "sqft_above"),
    ("l_quantity * 200", "sqft_basement"),
    ("1900 + l_quantity * 2", "yr_built"),
    ("CASE WHEN l_linenumber = 5 THEN 1890 + l_quantity * 3 ELSE 0.0 END", "yr_renovated"),
    ("CASE WHEN l_linenumber = 7 AND l_quantity > 40 THEN CAST(l_suppkey AS STRING) ELSE CAST(97990 + l_suppkey AS STRING) END",
     "zipcode"),
    ("47 + l_discount * 9", "lat"),
    ("-123 + l_tax * 26", "long"),
    ("CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(floor(l_extendedprice / 5) AS DOUBLE) END", "sqft_living15"),
    ("CAST(500 + l_suppkey * 100 AS DOUBLE)", "sqft_lot15"),
]
# Key lookup derived from supplier: one row per 5-digit key; suppliers with a
# negative balance are absent, so some request keys find no match.
ZIP_LOOKUP = ("SELECT CAST(97990 + s_suppkey AS STRING) AS zipcode, s_acctbal AS zip_acctbal, "
              "s_nationkey AS zip_nation FROM supplier WHERE s_acctbal > 0")
REQUEST_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def requests_cte(name: str = "requests", extra: str = "") -> str:
    cols = ", ".join(f'{e} AS "{a}"' for e, a in REQUEST_FIELDS)
    return f"{name} AS (SELECT {', '.join(REQUEST_IDS)}, {cols}{', ' + extra if extra else ''} FROM lineitem)"


def request_json_sql() -> str:
    """JSON body of each derived request (same text in Spark and DuckDB); a
    few bodies are cut short (malformed)."""
    parts = []
    for i, (_, a) in enumerate(REQUEST_FIELDS):
        val = f"'\"' || {a} || '\"'" if a == "zipcode" else f"coalesce(CAST({a} AS STRING), 'null')"
        parts.append(f"'{'{' if i == 0 else ', '}\"{a}\": ' || {val}")
    body = " || ".join(parts) + " || '}'"
    return f"CASE WHEN l_linenumber = 6 AND bathrooms > 9 THEN substr({body}, 1, 40) ELSE {body} END"


def rule_sql(rule: dict) -> str:
    """DuckDB text of 'rule is broken' for the oracle."""
    k, c = rule["kind"], f'"{rule.get("col")}"'
    if k == "required":
        return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' OR isnan(TRY_CAST({c} AS DOUBLE)))"
    if k == "range":
        x = f"TRY_CAST({c} AS DOUBLE)"
        return f"({c} IS NOT NULL AND ({x} IS NULL OR isnan({x}) OR {x} < {rule['lo']} OR {x} > {rule['hi']}))"
    if k == "integer":
        x = f"TRY_CAST({c} AS DOUBLE)"
        return f"({c} IS NOT NULL AND ({x} IS NULL OR {x} <> floor({x})))"
    if k == "pattern":
        return f"({c} IS NOT NULL AND NOT regexp_matches(CAST({c} AS VARCHAR), '{rule['regex']}'))"
    if k == "expr":
        return f"coalesce(({rule['sql']}), false)"
    raise ValueError(k)


def errors_sql(rules: list[dict]) -> str:
    items = ", ".join(f"CASE WHEN {rule_sql(r)} THEN '{r['name']}' END" for r in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"
