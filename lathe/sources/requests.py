"""Request records: JSON bodies parsed into typed columns, and the request
view derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathe.sources.tables import read_table


def parse_json(df: DataFrame, json_col: str, schema: T.StructType | str, keep: list[str] = (),
               error_col: str = "parse_error") -> DataFrame:
    """Parse a JSON text column into typed columns, without inference. Each
    body is parsed once, to VARIANT, from which the fields are taken by type:

    * ``parse_error`` is true for text that is no JSON object (fields NULL);
    * ``absent_fields`` names the fields whose key the object lacks;
    * ``wrong_type_fields`` those with a value that the type does not take (a
      number in a text field, text that is no number in a numeric one).

    An explicit ``null`` is NULL and in neither list."""
    if isinstance(schema, str):
        schema = df.sparkSession.createDataFrame([], schema).schema
    # JSON that parses is an object where its first character says so
    body = F.when(F.col(json_col).rlike(r"^[ \t\n\r]*\{"), F.try_parse_json(F.col(json_col)))
    parsed = df.select(*keep, body.alias("_v"))
    # each field is looked up once; its value, absence and type are taken from what was found
    raw = {f.name: f"_raw_{i}" for i, f in enumerate(schema)}
    found = parsed.select(*keep, F.col("_v").isNull().alias(error_col),
                          *[F.expr(f"try_variant_get(_v, '$.{name}', 'variant')").alias(r) for name, r in raw.items()])

    def value(f: T.StructField) -> str:
        if isinstance(f.dataType, T.StringType):
            return f"CASE WHEN schema_of_variant({raw[f.name]}) = 'STRING' THEN try_variant_get({raw[f.name]}, '$', 'string') END"
        return f"try_variant_get({raw[f.name]}, '$', '{f.dataType.simpleString()}')"

    typed = found.select(*keep, error_col, *[F.expr(value(f)).alias(f.name) for f in schema],
                         *[F.col(r).isNull().alias(f"_no{r}") for r in raw.values()],
                         *[F.expr(f"{r} IS NOT NULL AND NOT is_variant_null({r})").alias(f"_given{r}") for r in raw.values()])
    named = lambda cond: F.when(~F.col(error_col), F.array_compact(F.array(*[
        F.when(cond(f.name), F.lit(f.name)) for f in schema])))
    return typed.select(
        *keep, *[f.name for f in schema], error_col, named(lambda c: F.col(f"_no{raw[c]}")).alias("absent_fields"),
        named(lambda c: F.col(f"_given{raw[c]}") & F.col(c).isNull()).alias("wrong_type_fields"))


def requests_frame(spark: SparkSession, sf_dir: str, extra: list[str] = ()) -> DataFrame:
    """Full-request records derived from ``lineitem`` (see
    ``lathe.plans.sqlparts.REQUEST_FIELDS``); ``extra`` adds SQL columns."""
    from lathe.plans.sqlparts import REQUEST_FIELDS, REQUEST_IDS

    li = read_table(spark, sf_dir, "lineitem", balance=True)
    return li.selectExpr(*REQUEST_IDS, *[f"{e} AS `{a}`" for e, a in REQUEST_FIELDS], *extra)
