import pytest
from pyspark.sql import functions as F

from lathe.operators import validate as V
from lathe.operators.enrich import dedup_lookup, enrich, join_missing_count, unmatched
from lathe.sources.requests import parse_json

GOOD = {"bedrooms": "4", "bathrooms": "2.5", "sqft_living": "2630", "sqft_lot": "4501", "floors": "2.0",
        "waterfront": "0", "view": "0", "condition": "3", "grade": "8", "sqft_above": "2630", "sqft_basement": "0",
        "yr_built": "2015", "yr_renovated": "0", "zipcode": "98028", "lat": "47.7748", "long": "-122.244",
        "sqft_living15": "2380", "sqft_lot15": "4599"}
FIELDS = list(GOOD)


def _req(spark, rows):
    return spark.createDataFrame([tuple([i] + [r.get(f) for f in FIELDS]) for i, r in enumerate(rows)],
                                 "id int, " + ", ".join(f"{f} string" for f in FIELDS))


def _errors(spark, rows, rules=None):
    df = V.with_errors(_req(spark, rows), rules or V.full_request_rules())
    return {r["id"]: r["errors"] for r in df.collect()}


def test_valid_request_has_no_errors(spark):
    assert _errors(spark, [GOOD]) == {0: []}


@pytest.mark.parametrize("field,value,rule", [
    ("bedrooms", "21", "bedrooms_range"), ("bedrooms", "4.5", "bedrooms_integer"), ("bedrooms", None, "bedrooms_required"),
    ("bathrooms", "10.5", "bathrooms_range"), ("sqft_lot", "499", "sqft_lot_range"), ("floors", "0.5", "floors_range"),
    ("lat", "48.1", "lat_range"), ("long", "-120.9", "long_range"), ("zipcode", "9802", "zipcode_format"),
    ("zipcode", "98a28", "zipcode_format"), ("zipcode", None, "zipcode_required"), ("grade", "14", "grade_range"),
    ("sqft_living15", "50", "sqft_living15_range"), ("bedrooms", "abc", "bedrooms_integer"),
])
def test_each_rule_broken_once(spark, field, value, rule):
    r = dict(GOOD, **{field: value})
    assert rule in _errors(spark, [r])[0]


def test_integers_accept_text_and_float_forms(spark):
    assert _errors(spark, [dict(GOOD, bedrooms="4.0"), dict(GOOD, bedrooms="4")]) == {0: [], 1: []}


def test_optional_absent_passes_and_two_rules_at_once(spark):
    e = _errors(spark, [dict(GOOD, waterfront=None, sqft_living15=None), dict(GOOD, bedrooms="30", lat="50")])
    assert e[0] == [] and e[1] == ["bedrooms_range", "lat_range"]


def test_cross_field_rule(spark):
    e = _errors(spark, [dict(GOOD, yr_built="2000", yr_renovated="1990"),
                        dict(GOOD, yr_built="1800", yr_renovated="1700"),  # built invalid → cross rule skipped
                        dict(GOOD, yr_built="2000", yr_renovated="0")])
    assert "renovation_before_built" in e[0]
    assert "renovation_before_built" not in e[1] and "yr_built_range" in e[1]
    assert e[2] == []


def test_minimal_rules_ignore_extra_fields(spark):
    e = _errors(spark, [dict(GOOD, lat="99", grade="99")], V.minimal_request_rules())
    assert e == {0: []}


def test_validate_splits_rows(spark):
    valid, rejected = V.validate(_req(spark, [GOOD, dict(GOOD, bedrooms="99")]), V.full_request_rules())
    assert valid.count() == 1 and rejected.count() == 1 and "errors" in rejected.columns


def test_report_counts(spark):
    rep = {r["rule"]: r["violations"] for r in V.validation_report(
        _req(spark, [GOOD, dict(GOOD, bedrooms="99"), dict(GOOD, bedrooms="98")]), V.full_request_rules()).collect()}
    assert rep["bedrooms_range"] == 2 and rep["lat_range"] == 0


def test_normalise_and_defaults(spark):
    df = spark.createDataFrame([("3.9", "98001.0"), ("-2.5", "123"), ("7", "1234567")], "b string, z string")
    out = [(r["b"], r["z"]) for r in V.normalise(df, int_cols=["b"], key="z").collect()]
    assert out == [(3, "98001"), (-2, "00123"), (7, "1234567")]  # truncation; longer keys kept whole
    js = spark.createDataFrame([('{"view": 2}',), ('{"view": null}',), ("{}",)], "j string")
    parsed = js.select("j", F.from_json("j", "view INT, grade INT").alias("r")).select("j", "r.*")
    got = [(r["view"], r["grade"]) for r in V.apply_defaults(parsed, {"view": 0, "grade": 7}, json_col="j").collect()]
    assert got == [(2, 7), (None, 7), (0, 7)]  # explicit null stays null


def test_coerce_numeric_lists_invalid(spark):
    df = spark.createDataFrame([("1.5", "x"), ("NaN", "2")], "a string, b string")
    got = [r["invalid_features"] for r in V.coerce_numeric(df, ["a", "b"]).collect()]
    assert got == [["b"], ["a"]]


def test_dataset_checks(spark):
    df = spark.createDataFrame([(1.0, None, float("inf")), (2.0, None, 1.0)], "y double, a double, b double")
    checks = {r["check"]: r["passed"] for r in V.check_dataset(df, ["a", "b"], "y").collect()}
    assert checks == {"not_empty": True, "no_all_null_columns": False, "target_not_all_null": True,
                      "no_infinite_features": False, "no_infinite_target": True}
    with pytest.raises(ValueError, match="no_all_null_columns"):
        V.raise_on_failure(V.check_dataset(df, ["a", "b"], "y"))
    empty = spark.createDataFrame([], "y double, a double")
    assert {r["check"]: r["passed"] for r in V.check_dataset(empty, ["a"], "y").collect()}["not_empty"] is False
    q = V.quality_gate(df, ["a", "b"], "y").first()
    assert q["enough_samples"] is False and q["missing_ok"] is True and q["passed"] is False


def test_enrich_null_keys_duplicates_and_override(spark):
    sales = spark.createDataFrame([(1, "a", 5.0), (2, None, 6.0), (3, "zz", 7.0)], "id int, k string, v double")
    lk = spark.createDataFrame([("a", 10.0, 1.0), ("a", 11.0, 2.0), (None, 99.0, 3.0)], "k string, v double, w double")
    left = enrich(sales, lk, "k")
    assert left.count() == 4  # duplicate lookup keys multiply rows; unmatched kept
    assert left.filter("id = 1").select("v").distinct().count() == 2  # lookup wins the name clash
    ns = enrich(sales, lk, "k", null_safe=True)
    assert ns.filter("id = 2").first()["w"] == 3.0  # NULL key matches NULL key (pandas merge)
    first = dedup_lookup(lk, "k", [F.col("w")])
    one = enrich(sales, first, "k", flag=True, drop_key=True)
    assert one.count() == 3 and "k" not in one.columns
    assert {r["id"]: r["_matched"] for r in one.collect()} == {1: True, 2: False, 3: False}
    assert [r["id"] for r in unmatched(sales, lk, "k").orderBy("id").collect()] == [2, 3]
    with pytest.raises(ValueError):
        enrich(sales, lk, "nope")


def test_join_missing_count(spark):
    sales = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    lk = spark.createDataFrame([("a", 1.0, 2.0)], "k string, x double, y double")
    r = join_missing_count(sales, enrich(sales, lk, "k")).first()
    assert (r["nulls_before"], r["nulls_after"], r["missing_added"]) == (0, 2, 2)


def test_parse_json_errors(spark):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, "not json"), (3, "[1]")], "id int, j string")
    got = {r["id"]: (r["k"], r["parse_error"]) for r in parse_json(df, "j", "k INT", keep=["id"]).collect()}
    assert got == {1: (3, False), 2: (None, True), 3: (None, True)}


def test_parse_json_tells_absent_null_and_wrong_type_apart(spark):
    from lathe.operators import validate as V

    df = spark.createDataFrame([(1, '{"z": "00123", "n": 3, "m": null}'), (2, '{"z": 123, "n": "abc", "m": "4"}'), (3, "{}"),
                                (4, "[1]"), (5, '{"z": null, "n": 1.5}'), (6, None)], "id int, j string")
    got = parse_json(df, "j", "z STRING, n DOUBLE, m DOUBLE", keep=["id"])
    rows = {r["id"]: r for r in got.collect()}
    pick = lambda i: (rows[i]["z"], rows[i]["n"], rows[i]["m"], rows[i]["parse_error"])
    assert pick(1) == ("00123", 3.0, None, False) and rows[1]["absent_fields"] == [] and rows[1]["wrong_type_fields"] == []
    assert pick(2) == (None, None, 4.0, False) and rows[2]["wrong_type_fields"] == ["z", "n"]  # a number is no key text
    assert pick(3) == (None, None, None, False) and rows[3]["absent_fields"] == ["z", "n", "m"]
    assert pick(4) == pick(6) == (None, None, None, True)
    assert pick(5) == (None, 1.5, None, False) and rows[5]["absent_fields"] == ["m"]
    filled = V.apply_defaults(got, {"n": 7, "m": 9}, absent_col="absent_fields")
    assert {r["id"]: (r["n"], r["m"]) for r in filled.collect()} == {
        1: (3.0, None), 2: (None, 4.0), 3: (7.0, 9.0), 4: (None, None), 5: (1.5, 9.0), 6: (None, None)}
    broken = V.with_errors(got, [V.malformed_rule(), V.wrong_type_rule()])
    assert {r["id"]: r["errors"] for r in broken.collect()} == {
        1: [], 2: ["wrong_type"], 3: [], 4: ["malformed_json"], 5: [], 6: ["malformed_json"]}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1


def test_empty_lookup_raises_and_missing_columns_listed(spark, tmp_path):
    from lathe.sources.tables import scan_select

    sales = spark.createDataFrame([(1, "a")], "id int, k string")
    empty = spark.createDataFrame([], "k string, x double")
    with pytest.raises(ValueError, match="empty"):
        enrich(sales, empty, "k")
    assert enrich(sales, empty, "k", allow_empty_lookup=True).count() == 1
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, 2.0, "z")], "a int, b double, c string").write.parquet(path)
    assert scan_select(spark, path, ["c", "a"]).columns == ["c", "a"]  # requested order
    with pytest.raises(ValueError, match=r"\['d', 'e'\]"):
        scan_select(spark, path, ["a", "d", "e"])


def test_fingerprint_is_order_free(spark):
    from lathe.sources.sinks import fingerprint

    df = spark.range(200).selectExpr("id", "cast(id % 7 as string) AS s")
    a = fingerprint(df).first()
    b = fingerprint(df.orderBy(F.desc("id")).repartition(5)).first()
    assert (a["n_rows"], a["digest"], a["schema"]) == (b["n_rows"], b["digest"], b["schema"])
    assert fingerprint(df.limit(199)).first()["digest"] != a["digest"]


def test_hot_key_plans_limit_before_shuffle(spark):
    # a key holding a third of the rows: first-match dedup limits per task before the exchange
    lk = spark.range(3000).selectExpr("CASE WHEN id < 1000 THEN 0 ELSE id END AS k", "id AS v")
    d = dedup_lookup(lk, "k", [F.col("v")])
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert d.count() == 2001 and d.filter("k = 0").first()["v"] == 0


def test_iso_utc_text(spark):
    import datetime as dt

    from lathe.functions.columns import iso_utc

    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 123456),)], "ts timestamp")
    assert df.select(iso_utc("ts").alias("t")).first()["t"] == "2024-01-02T03:04:05.123456Z"


def test_rules_stay_out_of_whole_stage_code(spark):
    """All rules in one generated method are more than Java compiles."""
    from lathe.operators import validate as V
    from lathe.plans.sqlparts import REQUEST_FIELDS

    df = spark.range(3).selectExpr(*[f"CAST({'id' if a == 'zipcode' else 'id * 0.5D'} AS {'STRING' if a == 'zipcode' else 'DOUBLE'}) AS `{a}`"
                                     for _, a in REQUEST_FIELDS])
    plan = V.validate(df, V.full_request_rules())[0]._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not [line for line in filters if "*(" in line]
    assert "0.5) as string) as double" not in plan  # numbers are not compared by way of text


def test_renovation_rule_of_numbers_equals_that_of_text(spark):
    from lathe.operators import validate as V

    df = spark.sql("SELECT * FROM VALUES (1950D, 1940D), (1950D, 1960D), (NULL, 1940D), (1950D, NULL), (double('NaN'), 1D), "
                   "(1950.5D, 1D), (1950D, 0D), (2025D, 2024D), (double('Infinity'), 5D), (1950D, double('NaN')) t(yr_built, yr_renovated)")
    text = df.selectExpr("CAST(yr_built AS STRING) yr_built", "CAST(yr_renovated AS STRING) yr_renovated")
    rules = [V.renovation_rule()]
    flags = [[r["_v"] for r in V.with_errors(d, rules, valid_col="_v").select("_v").collect()] for d in (df, text)]
    assert flags[0] == flags[1] == [False, True, True, True, True, True, True, False, True, True]


def test_parse_json_looks_each_field_up_once(spark):
    df = spark.createDataFrame([(1, '{"z": "a", "n": "1.5"}'), (2, ' \n{"n": null}'), (3, '[1]'), (4, '{"z": 1'), (5, None)], "id int, j string")
    out = parse_json(df, "j", "z STRING, n DOUBLE", keep=["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("$.n,") == 1 and plan.count("$.z,") == 1
    got = {r["id"]: tuple(r)[1:] for r in out.collect()}
    assert got == {1: ("a", 1.5, False, [], []), 2: (None, None, False, ["z"], []), 3: (None, None, True, None, None),
                   4: (None, None, True, None, None), 5: (None, None, True, None, None)}
