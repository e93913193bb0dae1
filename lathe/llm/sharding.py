"""Sharding by proportional stratified interleaving, on DataFrame functions only.

1. Rows of a source are put in a seeded order: the md5 of (seed, id, text).
2. Row r (from 1) of a source of n rows has the fractional rank (2r - 1) / 2n,
   so every source is spread evenly over 0 to 1.
3. All rows are sorted by fractional rank, source (null last) and r, and cut
   into equal runs: shard j holds the positions with ``position * shards div
   rows = j``. Row counts of shards differ by at most one (law ``rows``), and
   each holds its share of every source to within one row at either cut.

Equal texts are not held together: under this law a group of copies that is
larger than a shard has to be split, and smaller ones are dealt like any rows.

Scale: no task sorts a whole source or the whole table. Ranks are counted in
buckets of the order's key (a hash, so buckets are even; a hot source has as
many as any), offset by the row counts of the buckets before. The only windows
over a whole source or table run over bucket counts, at most ``16 ** DIGITS``
of them. Rows are written between the two orders, so a retried task reads the
same rows.

Defined results: a null text has no bytes (size 1) and the checksum of the
empty text; a null source is a source of its own, after all others; a null id
is ordered like an id; rows equal in id, text and source are interchangeable,
each has its own slot; an empty table gives an empty result. Other columns
pass through ``interleaved``; an input column named like one of its outputs is
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import table, text_or_empty
from lathe.llm.registry import register
from lathe.session import materialize

SHARDS = 8
SEED = 29
BUCKET_ROWS = 10_000  # rows aimed at in a bucket of an order
DIGITS = 4  # a bucket is at most so many hex digits of a key


def _digits(rows: int) -> int:
    """Hex digits for buckets of about ``BUCKET_ROWS`` rows, 2 to ``DIGITS``."""
    d = 2
    while d < DIGITS and rows > BUCKET_ROWS * 16 ** d:
        d += 1
    return d


def _ranked(df: DataFrame, group: list[str], bucket: Column, order: list[Column]) -> DataFrame:
    """``_rank`` (from 1) of each row within ``group`` and ``_of``, the group's
    rows. ``bucket`` must not fall along ``order``; both are over columns of
    ``df`` that hold no null."""
    df = df.withColumn("_bucket", bucket)
    cut = [*group, "_bucket"]
    counts = df.groupBy(*cut).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*(group or [F.lit(1)]))  # bucket counts only: at most 16 ** DIGITS of a group
    starts = counts.select(*cut, (F.sum("_n").over(whole.orderBy("_bucket")) - F.col("_n")).alias("_start"),
                           F.sum("_n").over(whole).alias("_of"))
    row = F.row_number().over(Window.partitionBy(*cut).orderBy(*order))
    return (df.withColumn("_row", row).join(starts, cut)
            .withColumn("_rank", F.col("_start") + F.col("_row")).drop("_row", "_start", "_bucket"))


def interleaved(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text", seed: int = SEED) -> DataFrame:
    """All rows and columns of ``df`` with ``_shard`` (0 to ``shards`` - 1) and
    ``_slot`` (from 0, without gaps)."""
    carried = [c for c in df.columns if c.lower() not in ("_shard", "_slot")]
    keyed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_data"),
        F.coalesce(F.concat(F.lit("0"), F.col(source_col).cast("string")), F.lit("1")).alias("_source"),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("n")),
                          F.md5(text_or_empty(text_col)))).alias("_key"))
    return _cut(materialize(keyed, "keyed"), shards).select("_data.*", "_shard", "_slot")


def _cut(rows: DataFrame, shards: int) -> DataFrame:
    """Shard and slot of rows with ``_source`` and ``_key``."""
    n = rows.count()
    d = _digits(n)
    ranked = _ranked(rows, ["_source"], F.substring("_key", 1, d), [F.col("_key")])
    ranked = materialize(ranked.withColumn("_fraction", (2 * F.col("_rank") - 1) / (2 * F.col("_of")))
                         .withColumnRenamed("_rank", "_place").drop("_of", "_key"), "fractions")
    at = F.least(F.floor(F.col("_fraction") * 16 ** d), F.lit(16 ** d - 1))  # fractional ranks are even by construction
    out = _ranked(ranked, [], at, [F.col("_fraction"), F.col("_source"), F.col("_place")])
    position = (F.col("_rank") - 1).cast("long")
    shard = F.expr(f"((_rank - 1) * {shards}L) div {max(n, 1)}L")
    start = F.expr(f"((((_rank - 1) * {shards}L) div {max(n, 1)}L) * {n}L + {shards - 1}L) div {shards}L")
    return out.withColumns({"_shard": shard.cast("int"), "_slot": (position - start).cast("long")})


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, **columns) -> None:
    """Writes the shards as folders ``_shard=j`` of Parquet files; rows lie by
    slot within a file, and files of a shard hold successive slots. A shard is
    written by as many tasks as its rows need."""
    out = interleaved(df, shards, **columns)
    n = max(shards, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (out.repartitionByRange(n, "_shard", "_slot").sortWithinPartitions("_shard", "_slot")
     .write.partitionBy("_shard").mode("overwrite").parquet(path))


def shard_report(df: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per document."""
    text = text_or_empty(text_col)
    rows = df.select(
        F.struct(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                 F.crc32(text).alias("text_crc32")).alias("_data"),
        F.coalesce(F.concat(F.lit("0"), F.col(source_col).cast("string")), F.lit("1")).alias("_source"),
        F.md5(F.concat_ws("|", F.lit(str(SEED)), F.coalesce(F.col(id_col).cast("string"), F.lit("n")),
                          F.md5(text))).alias("_key"))
    return _cut(materialize(rows, "keyed"), SHARDS).select(
        "_data.doc_id", "_data.size", "_data.text_crc32", F.lit("rows").alias("law"), F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _oracle() -> str:
    """The same order in DuckDB; the checksum is folded byte by byte."""
    table = []
    for b in range(256):
        for _ in range(8):
            b = b >> 1 ^ 0xEDB88320 * (b & 1)
        table.append(b)
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, source,
         md5(concat_ws('|', '{SEED}', coalesce(doc_id::VARCHAR, 'n'), md5(coalesce(text, '')))) AS key FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY key) AS place,
             count(*) OVER (PARTITION BY source) AS n FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY (2 * place - 1) / (2 * n), source NULLS LAST, place) - 1 AS pos,
             count(*) OVER () AS rows FROM r)
SELECT doc_id, strlen(text)::BIGINT + 1 AS size,
       xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT),
         lambda c, b: xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))::BIGINT AS text_crc32,
       'rows' AS law, (pos * {SHARDS} // rows)::INT AS shard,
       (pos - ((pos * {SHARDS} // rows) * rows + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard
FROM p
"""


@register("op13_sharding", _oracle())
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(table(spark, sf_dir, "documents"))
