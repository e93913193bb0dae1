"""Batch scoring with dead letter, minimal scoring, error breakdown, finite
guard, A/B comparison of two models, full-vs-minimal, prediction log."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.functions.columns import is_finite, pct_diff
from lathe.operators import compare as C
from lathe.operators import scoring as SC
from lathe.operators import validate as V
from lathe.operators.models import booster_params, fit_group_mean, predict_group_mean
from lathe.operators.pipeline import RegressionPipeline, load_pipeline, preset, save_pipeline
from lathe.operators.split import split
from lathe.plans import sqlparts as S
from lathe.plans.boost_sql import booster_sql
from lathe.plans.q_core import SCORED_SQL
from lathe.plans.registry import register, rounded
from lathe.session import materialize, new_path
from lathe.sources.requests import requests_frame
from lathe.sources.sinks import LOG_COLUMNS, to_log_records
from lathe.sources.tables import SALES_ID, prediction_log_frame, read_table, sales_frame

# the optional fields are ones that a minimal request lacks: there the model sees their defaults
MODEL_FEATURES = SC.CORE_FEATURES + ["waterfront", "view", "condition", "grade", "zip_acctbal", "zip_nation"]
MODEL_NAME, MODEL_KIND = "request_price", "xgboost"
MODEL_PARAMS = {"n_estimators": 8, "max_depth": 3, "learning_rate": 0.3, "colsample_bytree": 1.0, "max_bins": 64}
IDS = S.REQUEST_IDS


def zip_lookup(spark, sf):
    return read_table(spark, sf, "supplier").selectExpr(
        "CAST(97990 + s_suppkey AS STRING) AS zipcode", "s_acctbal AS zip_acctbal",
        "CAST(s_nationkey AS DOUBLE) AS zip_nation", "s_acctbal").filter("s_acctbal > 0").drop("s_acctbal")


_REGISTRIES: dict = {}  # by application and tables: where the fitted model was saved


def request_registry(spark, sf) -> str:
    """Registry folder with the price model of the valid, matched requests,
    fitted and saved once per application and set of tables."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _REGISTRIES:
        req = V.apply_defaults(requests_frame(spark, sf, ["l_extendedprice AS price"]), V.REQUEST_DEFAULTS)
        valid, _ = V.validate(req, V.full_request_rules())
        train = valid.join(zip_lookup(spark, sf), "zipcode")
        pipe = preset(MODEL_KIND, MODEL_FEATURES, "price", **MODEL_PARAMS).fit(train, "l_orderkey")
        root = new_path(spark, "registry")
        save_pipeline(spark, pipe, root, MODEL_NAME, 1)
        _REGISTRIES[key] = root
    return _REGISTRIES[key]


def request_model(spark, sf) -> RegressionPipeline:
    """The saved model, loaded by URI."""
    return load_pipeline(spark, request_registry(spark, sf), f"models:/{MODEL_NAME}/latest")


def score_frame(req, spark, sf, rules, model=None, keep=(), **kw):
    """``req`` scored with the saved model as a column expression."""
    model = model if model is not None else request_model(spark, sf)
    return SC.score(req, zip_lookup(spark, sf), "zipcode", model.column(), model.features, rules, [*IDS, *keep],
                    str(model.version), model.model, **kw)


def score_requests(spark, sf, minimal=False, model=None):
    req = requests_frame(spark, sf)
    if minimal:
        req = SC.minimal_projection(req, IDS)
    rules = V.minimal_request_rules() if minimal else V.full_request_rules()
    return score_frame(req, spark, sf, rules, model, prediction_type="minimal" if minimal else "full")


def _filled(cols) -> str:
    return ", ".join(f"coalesce({c}, {V.REQUEST_DEFAULTS[c]}) AS {c}" for c in V.REQUEST_DEFAULTS if c in cols)


def _score_sql(minimal=False, req_sql=None, rules=None, extra=""):
    """CTEs ending in ``res``; the model is fitted in SQL over the same rows."""
    rules = rules or (V.minimal_request_rules() if minimal else V.full_request_rules())
    fields = [a for _, a in S.REQUEST_FIELDS]
    if minimal:
        lacking = ", ".join(f"CAST({V.REQUEST_DEFAULTS[c]} AS DOUBLE) AS {c}" for c in MODEL_FEATURES
                            if c in V.REQUEST_DEFAULTS and c not in SC.CORE_FEATURES)
        req_sql = (f"SELECT * REPLACE ({_filled(SC.CORE_FEATURES)}), {lacking} FROM "
                   f"(SELECT rid, {', '.join(IDS + SC.CORE_FEATURES)}, zipcode FROM req0)")
    req_sql = req_sql or f"SELECT * EXCLUDE (price) REPLACE ({_filled(fields)}) FROM req0"
    feats_null = ", ".join(f"CASE WHEN {c} IS NULL OR isnan({c}) THEN '{c}' END" for c in MODEL_FEATURES)
    feats = ", ".join(MODEL_FEATURES)  # request ids repeat: rows are told apart by rid
    model = booster_sql("src", ["rid"], "price", MODEL_FEATURES, booster_params(MODEL_KIND, **MODEL_PARAMS), only="NOT s.fitted")
    return f"""WITH RECURSIVE {S.requests_cte('req0', extra + 'l_extendedprice AS price, row_number() OVER () AS rid').replace('req0 AS (', 'req0 AS MATERIALIZED (')},
zl AS ({S.ZIP_LOOKUP.replace('s_nationkey AS zip_nation', 'CAST(s_nationkey AS DOUBLE) AS zip_nation')}),
trainreq AS (SELECT * REPLACE ({_filled(fields)}) FROM req0 WHERE len({S.errors_sql(V.full_request_rules())}) = 0),
req AS ({req_sql}),
chk AS (SELECT r.*, {S.errors_sql(rules)} AS errors FROM req r),
enr AS (SELECT c.*, zl.zip_acctbal, zl.zip_nation, zl.zipcode IS NOT NULL AS matched FROM chk c LEFT JOIN zl USING (zipcode)),
co AS (SELECT *, list_filter([{feats_null}], lambda x: x IS NOT NULL) AS invalid FROM enr),
src AS MATERIALIZED (
  SELECT rid, {feats}, price, true AS train FROM trainreq JOIN zl USING (zipcode)
  UNION ALL SELECT rid, {feats}, NULL, false FROM co WHERE len(errors) = 0 AND matched AND len(invalid) = 0),
{model},
pr AS (SELECT co.*, b.prediction AS pred FROM co LEFT JOIN boosted b USING (rid)),
res AS (SELECT *, CASE WHEN len(errors) > 0 THEN 'VALIDATION_ERROR' WHEN NOT matched THEN 'DEMOGRAPHIC_DATA_ERROR'
                       WHEN len(invalid) > 0 THEN 'PREDICTION_ERROR' WHEN pred IS NULL OR isnan(pred) OR isinf(pred)
                       THEN 'PREDICTION_ERROR' END AS error_code FROM pr)"""


_OUT = f"{', '.join(IDS)}, zipcode, round(CASE WHEN error_code IS NULL THEN pred END, 6) AS prediction, " \
       f"'1' AS model_version, '{MODEL_KIND}' AS model_type, {len(MODEL_FEATURES)} AS features_used"


@register("score_batch", f"{_score_sql()} SELECT {_OUT}, 'full' AS prediction_type, error_code FROM res")
def q_score_batch(spark, sf):
    out = score_requests(spark, sf)
    return rounded(out.drop("timestamp", "message", "details"), 6)


@register("score_minimal", f"{_score_sql(True)} SELECT {_OUT}, 'minimal' AS prediction_type, error_code FROM res")
def q_score_minimal(spark, sf):
    out = score_requests(spark, sf, minimal=True)
    return rounded(out.drop("timestamp", "message", "details"), 6)


@register("error_breakdown", f"{_score_sql()} SELECT coalesce(error_code, 'OK') AS error_code, count(*) AS n FROM res "
                             "GROUP BY 1")
def q_error_breakdown(spark, sf):
    return SC.error_breakdown(score_requests(spark, sf))


@register("project_minimal", f"WITH {S.requests_cte()} SELECT {', '.join(IDS + SC.CORE_FEATURES)}, zipcode FROM requests")
def q_project_minimal(spark, sf):
    return SC.minimal_projection(requests_frame(spark, sf), IDS)


FINITE_SRC = ("CASE WHEN o_orderkey % 101 = 0 THEN CAST('Infinity' AS DOUBLE) "
              "WHEN o_orderkey % 103 = 0 THEN CAST('-Infinity' AS DOUBLE) "
              "WHEN o_orderkey % 107 = 0 THEN CAST('NaN' AS DOUBLE) "
              "WHEN o_orderkey % 109 = 0 THEN NULL ELSE o_totalprice / 2 END")


@register("finite_guard", f"""SELECT o_orderkey, CASE WHEN p IS NULL OR isnan(p) OR isinf(p) THEN 'PREDICTION_ERROR' END
  AS error_code, CASE WHEN NOT (p IS NULL OR isnan(p) OR isinf(p)) THEN p END AS prediction
FROM (SELECT o_orderkey, {FINITE_SRC} AS p FROM orders)""")
def q_finite_guard(spark, sf):
    o = read_table(spark, sf, "orders").selectExpr("o_orderkey", f"{FINITE_SRC} AS p")
    ok = F.coalesce(is_finite(F.col("p")), F.lit(False))
    return o.select("o_orderkey", F.when(~ok, F.lit(SC.PREDICTION_ERROR)).alias("error_code"),
                    F.when(ok, F.col("p")).alias("prediction"))


# ------------------------------------------------------------------ A/B on sales
def ab_predictions(spark, sf):
    """Model A: mean price per segment; model B: mean price per nation,
    which fails (NULL) on orders without lines (missing features). Both are
    fitted on the training split and applied to the test split."""
    s = materialize(split(sales_frame(spark, sf), [SALES_ID], 0.2, 42), "sales-split")
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    a = predict_group_mean(test, fit_group_mean(train, "c_mktsegment", "price"), "c_mktsegment", "pred_a")
    b = predict_group_mean(test, fit_group_mean(train, "c_nationkey", "price"), "c_nationkey", "pred_b")
    b = b.withColumn("pred_b", F.when(F.col("n_lines").isNotNull(), F.col("pred_b")))
    return a.select(SALES_ID, "price", "pred_a"), b.select(SALES_ID, "pred_b")


AB_SQL = f"""{SCORED_SQL},
te AS (SELECT * FROM splitted WHERE split = 'test'),
ma AS (SELECT c_mktsegment AS k, avg(price) AS mp FROM splitted WHERE split = 'train' GROUP BY 1),
mb AS (SELECT c_nationkey AS k, avg(price) AS mp FROM splitted WHERE split = 'train' GROUP BY 1),
ab AS (SELECT te.o_orderkey, te.price, coalesce(ma.mp, g.gp) AS pred_a,
              CASE WHEN te.n_lines IS NOT NULL THEN coalesce(mb.mp, g.gp) END AS pred_b
       FROM te LEFT JOIN ma ON te.c_mktsegment = ma.k LEFT JOIN mb ON te.c_nationkey = mb.k CROSS JOIN gmodel g),
pairs AS (SELECT o_orderkey, pred_a, pred_b, pred_a - pred_b AS diff,
                 CASE WHEN pred_a = 0 THEN 0.0 ELSE (pred_a - pred_b) / pred_a * 100 END AS pct
          FROM ab WHERE pred_a IS NOT NULL AND pred_b IS NOT NULL)"""


def pairs_frame(spark, sf):
    a, b = ab_predictions(spark, sf)
    return C.pair_predictions(a, b, SALES_ID, "pred_a", "pred_b")


@register("pair_predictions", f"{AB_SQL} SELECT o_orderkey, round(pred_a, 6) AS pred_a, round(pred_b, 6) AS pred_b, "
                              "round(diff, 6) AS diff, round(pct, 6) AS pct FROM pairs")
def q_pair_predictions(spark, sf):
    return rounded(pairs_frame(spark, sf), 6)


@register("diff_statistics", f"""{AB_SQL}
SELECT count(*) AS n_pairs, round(avg(abs(diff)), 6) AS mean_abs_diff, round(median(abs(diff)), 6) AS median_abs_diff,
       round(max(abs(diff)), 6) AS max_abs_diff, round(min(abs(diff)), 6) AS min_abs_diff,
       round(stddev_samp(abs(diff)), 6) AS std_abs_diff, round(avg(abs(pct)), 6) AS mean_abs_pct,
       round(median(abs(pct)), 6) AS median_abs_pct, round(max(abs(pct)), 6) AS max_abs_pct FROM pairs""")
def q_diff_statistics(spark, sf):
    return rounded(C.diff_statistics(pairs_frame(spark, sf)), 6)


@register("agreement_patterns", f"""{AB_SQL},
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE abs(pct) < 5) AS high,
             count(*) FILTER (WHERE abs(pct) >= 5 AND abs(pct) < 15) AS medium,
             count(*) FILTER (WHERE abs(pct) >= 15) AS low FROM pairs)
SELECT total, high, medium, low, round(high * 100.0 / total, 6) AS high_pct, round(medium * 100.0 / total, 6) AS medium_pct,
       round(low * 100.0 / total, 6) AS low_pct,
       CASE WHEN total < 2 THEN 'Insufficient data' WHEN high / total > 0.8 THEN 'Excellent'
            WHEN high / total > 0.6 THEN 'Good' WHEN high / total > 0.4 THEN 'Fair' ELSE 'Poor' END AS assessment FROM c""")
def q_agreement(spark, sf):
    return rounded(C.agreement(pairs_frame(spark, sf)), 6)


@register("success_rates", f"""{AB_SQL},
s AS (SELECT 'model_a' AS endpoint, count(*) AS total, count(pred_a) AS ok FROM ab
      UNION ALL SELECT 'model_b', count(*), count(pred_b) FROM ab)
SELECT endpoint, total, ok, round(ok * 100.0 / total, 6) AS success_pct FROM s""")
def q_success_rates(spark, sf):
    a, b = ab_predictions(spark, sf)
    both = a.join(b, SALES_ID, "left")
    return rounded(C.success_rates(both, {"model_a": "pred_a", "model_b": "pred_b"}), 6)


@register("prediction_ranges", f"""{AB_SQL}
SELECT 'model_a' AS model, round(min(pred_a), 6) AS min_pred, round(max(pred_a), 6) AS max_pred,
       round(avg(pred_a), 4) AS mean_pred FROM ab
UNION ALL SELECT 'model_b', round(min(pred_b), 6), round(max(pred_b), 6), round(avg(pred_b), 4) FROM ab""")
def q_prediction_ranges(spark, sf):
    a, b = ab_predictions(spark, sf)
    both = a.join(b, SALES_ID, "left")
    # a mean of many ~1e5 values: 4 places keep clear of summation-order noise
    return rounded(C.prediction_ranges(both, {"model_a": "pred_a", "model_b": "pred_b"}), 6, {"mean_pred": 4})


@register("ab_compare", f"""{AB_SQL}
SELECT 'group_mean' AS type_a, 'group_mean' AS type_b, 'segment' AS version_a, 'nation' AS version_b,
       1 AS features_a, 1 AS features_b, (SELECT count(*) FROM pairs) AS n_pairs,
       (SELECT round(avg(abs(diff)), 6) FROM pairs) AS mean_abs_diff,
       (SELECT round(count(*) FILTER (WHERE abs(pct) < 5) * 100.0 / count(*), 6) FROM pairs) AS high_agreement_pct""")
def q_ab_compare(spark, sf):
    pairs = pairs_frame(spark, sf)
    info = {"type_a": "group_mean", "type_b": "group_mean", "version_a": "segment", "version_b": "nation",
            "features_a": 1, "features_b": 1}
    return rounded(C.ab_summary(pairs, info), 6)


@register("full_vs_minimal", f"""WITH f AS ({_score_sql()} SELECT * FROM res),
m AS ({_score_sql(True)} SELECT * FROM res),
p AS (SELECT f.pred AS a, m.pred AS b FROM f JOIN m USING ({', '.join(IDS)})
      WHERE f.error_code IS NULL AND m.error_code IS NULL)
SELECT count(*) AS n_pairs, round(avg(abs(a - b)), 6) AS mean_abs_diff, round(max(abs(a - b)), 6) AS max_abs_diff,
       round(avg(abs(CASE WHEN a = 0 THEN 0.0 ELSE (a - b) / a * 100 END)), 6) AS mean_abs_pct,
       round(max(abs(CASE WHEN a = 0 THEN 0.0 ELSE (a - b) / a * 100 END)), 6) AS max_abs_pct FROM p""")
def q_full_vs_minimal(spark, sf):
    model = request_model(spark, sf)  # loaded once, used by both endpoints
    full = score_requests(spark, sf, model=model).filter("error_code IS NULL").select(
        *IDS, F.col("prediction").alias("a"))
    mini = score_requests(spark, sf, True, model=model).filter("error_code IS NULL").select(
        *IDS, F.col("prediction").alias("b"))
    p = full.join(mini, IDS, "inner").select((F.col("a") - F.col("b")).alias("d"), pct_diff("a", "b").alias("pct"))
    out = p.agg(F.count(F.lit(1)).alias("n_pairs"), F.avg(F.abs("d")).alias("mean_abs_diff"),
                F.max(F.abs("d")).alias("max_abs_diff"), F.avg(F.abs("pct")).alias("mean_abs_pct"),
                F.max(F.abs("pct")).alias("max_abs_pct"))
    return rounded(out, 6)


# ------------------------------------------------------------------ prediction log
LOG_SQL = """log AS (SELECT event_id AS id, ts, event_type AS endpoint, user_id, value AS predicted_price,
  TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS processing_time_ms, CAST(ts AS DATE) AS log_date FROM events)"""


# what a served request brings besides its fields; the same text in Spark and DuckDB
SERVED = [("date_trunc('year', l_shipdate)", "ts"), ("CASE WHEN l_linenumber % 2 = 0 THEN '/v2/predict' ELSE '/v1/predict' END", "endpoint"),
          ("l_quantity / 4", "processing_time_ms")]
LOG_NAMES = [c for c, _ in LOG_COLUMNS]


def log_sql() -> str:
    """The whole log row of every scored request."""
    types = {"int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    given = {"model_version": "'1'", "model_type": f"'{MODEL_KIND}'", "features_used": str(len(MODEL_FEATURES)),
             "prediction_type": "'full'", "predicted_price": "round(pred, 6)", "ts": "CAST(ts AS TIMESTAMP)"}
    cols = ", ".join(f"CAST({given.get(c, f'trunc({c})' if t == 'int' else c)} AS {types[t]}) AS {c}" if t in types
                     else f"{given[c]} AS {c}" for c, t in LOG_COLUMNS)
    served = "".join(f"{e} AS {a}, " for e, a in SERVED)
    return (f"{_score_sql(extra=served)} SELECT {', '.join(IDS)}, {cols}, CAST(ts AS DATE) AS log_date "
            "FROM res WHERE error_code IS NULL")


def served_requests(li):
    return li.selectExpr(*IDS, *[f"{e} AS `{a}`" for e, a in S.REQUEST_FIELDS + SERVED])


def score_served(req, spark, sf):
    """Scored rows that keep their request fields, for the log."""
    inputs = [a for _, a in S.REQUEST_FIELDS + SERVED if a != "zipcode"]
    return score_frame(req, spark, sf, V.full_request_rules(), keep=inputs)


def read_back(log):
    return rounded(log.select(*IDS, *[F.col(c).cast("timestamp_ntz").alias(c) if c == "ts" else F.col(c) for c in LOG_NAMES],
                              F.col("log_date").cast("date").alias("log_date")), 6)


@register("log_roundtrip", log_sql())
def q_log_roundtrip(spark, sf):
    """Every scored request as a whole log row: written, read back."""
    from lathe.sources.sinks import log_predictions, read_log

    path = new_path(spark, "prediction-log")
    scored = score_served(served_requests(read_table(spark, sf, "lineitem", balance=True)), spark, sf)
    log_predictions(to_log_records(SC.split_outcome(scored)[0], "predict", keep=IDS), path)
    return read_back(read_log(spark, path))


@register("log_stats", "SELECT count(*) AS total_predictions FROM events")
def q_log_stats(spark, sf):
    return C.log_stats(prediction_log_frame(spark, sf))


@register("log_by_endpoint", "SELECT event_type AS endpoint, count(*) AS n FROM events GROUP BY 1")
def q_log_by_endpoint(spark, sf):
    return C.log_by_endpoint(prediction_log_frame(spark, sf))


@register("recent_24h", """SELECT event_type AS endpoint, count(*) AS n FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1""")
def q_recent_24h(spark, sf):
    log = prediction_log_frame(spark, sf)
    as_of = log.agg(F.max("ts").alias("as_of"))
    return C.recent(log, as_of).groupBy("endpoint").agg(F.count(F.lit(1)).alias("n"))


@register("prediction_summary", f"""WITH {LOG_SQL}
SELECT endpoint, count(*) AS n, round(min(predicted_price), 6) AS min_price, round(max(predicted_price), 6) AS max_price,
       round(avg(predicted_price), 6) AS mean_price, round(median(predicted_price), 6) AS median_price,
       round(stddev_samp(predicted_price), 6) AS std_price, round(avg(processing_time_ms), 6) AS mean_time_ms,
       round(sum(processing_time_ms), 6) AS total_time_ms FROM log GROUP BY endpoint""")
def q_prediction_summary(spark, sf):
    log = prediction_log_frame(spark, sf).withColumn(
        "processing_time_ms", F.get_json_object("props", "$.k").cast("double"))
    return rounded(C.prediction_summary(log), 6)


# ------------------------------------------------------------------ JSON bodies
JSON_SCHEMA = ", ".join(f"`{a}` {'STRING' if a == 'zipcode' else 'DOUBLE'}" for _, a in S.REQUEST_FIELDS)


def _json_req_sql():
    fields = ", ".join(
        f"CASE WHEN ok THEN {'json_extract_string(sb, ' + repr('$.' + a) + ')' if a == 'zipcode' else 'TRY_CAST(json_extract_string(sb, ' + repr('$.' + a) + ') AS DOUBLE)'} END AS \"{a}\""
        for _, a in S.REQUEST_FIELDS)
    # DuckDB evaluates CASE branches eagerly: extract from a body that is always valid JSON
    return (f"SELECT rid, {', '.join(IDS)}, {fields}, NOT ok AS parse_error FROM (SELECT *, CASE WHEN ok THEN body "
            f"ELSE '{{}}' END AS sb FROM (SELECT rid, {', '.join(IDS)}, body, coalesce(json_valid(body) AND "
            f"json_type(CASE WHEN json_valid(body) THEN body ELSE '{{}}' END) = 'OBJECT', false) AS ok FROM "
            f"(SELECT rid, {', '.join(IDS)}, {S.request_json_sql()} AS body FROM req0)))")


_JSON_RULES = V.full_request_rules() + [V.malformed_rule(), V.wrong_type_rule()]


@register("score_json_requests", f"""{_score_sql(req_sql=_json_req_sql(), rules=_JSON_RULES)}
SELECT {_OUT}, 'full' AS prediction_type, error_code FROM res""")
def q_score_json(spark, sf):
    """JSON bodies → one VARIANT parse → rules, where a body that does not
    parse or has a field of another type is rejected → the same scoring. An
    explicit null stays null: the model refuses it."""
    from lathe.sources.requests import parse_json

    bodies = requests_frame(spark, sf).selectExpr(*IDS, f"{S.request_json_sql()} AS body")
    parsed = parse_json(bodies, "body", JSON_SCHEMA, keep=IDS)
    out = score_frame(parsed, spark, sf, _JSON_RULES, absent_col="absent_fields")
    return rounded(out.drop("timestamp", "message", "details"), 6)
