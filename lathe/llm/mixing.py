"""Mixing sources to target weights, on DataFrame functions only.

1. A document's size is its number of space-separated words. Sources in code
   point order (null last) weigh 5, 2, 1, repeating, and share ``SHARE`` times
   all words; a target stops at ``CAP`` times its source's words and the
   excess is shared again by weight until none is above.
2. Every source is dealt by hash into ``BLOCKS`` blocks of whole documents. Its
   quota (the rounded target) is a number of full passes over all blocks plus
   a rest; the rest is drawn block by block in a permuted order, without
   repeating one. Inside the one block where the rest ends, documents are
   drawn in a permuted order and the last is cut to the words still missing,
   so a source's taken words equal its quota.
3. The drawn blocks are dealt to ``SHARDS`` shards by a splitting tree: a node
   ranks its blocks by a hash of (node level, block) and gives the first half
   to its left child. Drawing half of the blocks without replacement makes the
   left child's block counts per source multivariate-hypergeometric, and the
   counts of both children add up to the node's exactly.
4. Inside a shard, rows are ordered by ``shuffle_key``, a hash.

Block, order and tree come from md5 of ids, so reruns agree on any layout.

Scale: totals, blocks and ranks are grouped aggregations over narrow rows.
A hot source is spread over its ``BLOCKS`` blocks; ranks use hash buckets, so
no task sorts all blocks; source order uses range partitions.

Defined results: a null or empty text has size 0 and takes 0 words; a null
source is a source of its own, last; a null id is dealt like an id; repeated
rows are separate documents that share a block; an empty table gives an empty
result. Other input columns pass through ``mixed`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import ordinals, rank_in, table, text_or_empty
from lathe.llm.registry import register
from lathe.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
BLOCKS = 256  # two hex digits of a hash
LEVELS = 4
SHARDS = 2 ** LEVELS
SEED = 17


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _name(source: Column) -> Column:
    """Text of a source in hashed keys; null differs from every name."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _hash(tag: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(f"{SEED}{tag}"), *[p.cast("string") for p in parts]))


def _id(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit("n"))


def targets(sized: DataFrame, source_col: str = "source", size_col: str = "size") -> DataFrame:
    """``source, source_size, target``: water-filling of the shares under the
    cap. Each round is one aggregate over the table of sources; the set of
    capped sources only grows, and rounds end when it stops growing."""
    totals = materialize(sized.groupBy(F.col(source_col).alias("_source")).agg(
        F.sum(size_col).cast("long").alias("source_size")), "sources")
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weighted = materialize(ordinals(totals, "_source", nulls_last=True).withColumn(
        "_w", F.get(weights, (F.col("_ordinal") % len(WEIGHTS)).cast("int"))), "weights")
    total, w = weighted.agg(F.sum("source_size"), F.sum("_w")).first()
    level, capped = (SHARE * total / w, 0) if total else (0.0, None)
    while capped is not None:
        over = F.col("source_size") * CAP <= F.lit(level) * F.col("_w")
        got = weighted.agg(F.count(F.when(over, 1)).alias("n"), F.sum(F.when(over, F.col("source_size"))).alias("held"),
                           F.sum(F.when(~over, F.col("_w"))).alias("w")).first()
        if got.n == capped:
            break
        level, capped = (SHARE * total - CAP * got.held) / got.w, got.n
    return weighted.select("_source", "source_size", F.least(
        F.col("source_size") * CAP, F.lit(level) * F.col("_w")).alias("target"))


def quotas(sized: DataFrame, id_col: str = "doc_id", source_col: str = "source",
           size_col: str = "size") -> DataFrame:
    """A row per (source, block): ``source_size, target, passes`` (times every
    block is taken whole), ``left`` (words of the rest that remain when the
    block's turn comes; 0 or less: not drawn), ``words`` and ``shards``, the
    shard of each copy."""
    goal = targets(sized, source_col, size_col)
    goal = goal.withColumn("_quota", F.floor(F.col("target") + 0.5).cast("long")).withColumn(
        "passes", F.when(F.col("source_size") > 0, F.floor(F.col("_quota") / F.col("source_size"))).otherwise(0)
        .cast("int")).withColumn("_rest", F.col("_quota") - F.col("passes") * F.col("source_size"))
    blocks = sized.groupBy(F.col(source_col).alias("_source"), block_of(id_col).alias("_block")).agg(
        F.sum(size_col).cast("long").alias("words"))
    blocks = blocks.join(goal.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    turn = (Window.partitionBy("_source").orderBy(_hash("b", _name(F.col("_source")), F.col("_block")))
            .rowsBetween(Window.unboundedPreceding, -1))  # BLOCKS rows of a source
    blocks = materialize(blocks.withColumn("left", F.col("_rest") - F.coalesce(F.sum("words").over(turn), F.lit(0)))
                         .drop("_quota", "_rest"), "blocks")
    drawn = F.col("passes") + F.when((F.col("left") > 0) & (F.col("words") > 0), 1).otherwise(0)
    copies = blocks.where(drawn > 0).select(
        "_source", "_block", F.explode(F.sequence(F.lit(0), drawn.cast("int") - 1)).alias("_pass"),
        F.lit(0).alias("_node"))
    for level in range(LEVELS):
        copies = rank_in(copies, ["_node"], _hash(f"t{level}", _name(F.col("_source")), F.col("_block"),
                                                  F.col("_pass")))
        copies = copies.withColumn("_node", F.col("_node") * 2 + F.when(
            F.col("_rank") * 2 <= F.col("_of") + 1, 0).otherwise(1)).drop("_rank", "_of")
    shards = copies.groupBy("_source", "_block").agg(  # at most CAP + 1 copies of a block
        F.array_sort(F.collect_list(F.struct("_pass", F.col("_node").alias("shard")))).alias("_copies"))
    shards = shards.select(F.col("_source").alias("_s"), F.col("_block").alias("_b"),
                           F.col("_copies.shard").alias("shards"))
    return materialize(blocks.join(shards, F.col("_source").eqNullSafe(F.col("_s")) & (
        F.col("_block") == F.col("_b")), "left").drop("_s", "_b"), "quotas")


def block_of(id_col: str) -> Column:
    return F.conv(F.substring(_hash("d", _id(id_col)), 1, 2), 16, 10).cast("int")


def draws(rows: DataFrame, plan: DataFrame, size: Column, id_col: str = "doc_id",
          source_col: str = "source") -> DataFrame:
    """``rows`` with the ``source_size, target, passes, shards`` of its block and
    ``extra``, the words of the document in its partial pass (null: the whole
    document), all prefixed ``_mix_``. Only the one block per source in which
    the rest ends is ordered."""
    plan = plan.select(*[F.col(c).alias(f"_mix_{c.strip('_')}") for c in plan.columns])
    got = rows.withColumn("_mix_of", block_of(id_col)).join(
        plan, F.col(source_col).eqNullSafe(F.col("_mix_source")) & (F.col("_mix_of") == F.col("_mix_block")))
    left, words = F.col("_mix_left"), F.col("_mix_words")
    ends = (left > 0) & (left < words)
    whole = got.where(~ends).withColumn("_mix_extra", F.when(left <= 0, F.lit(0)).cast("long"))
    before = (Window.partitionBy(source_col).orderBy(_hash("o", _id(id_col)), "_mix_size")
              .rowsBetween(Window.unboundedPreceding, -1))
    part = got.where(ends).withColumn("_mix_size", size)
    room = left - F.coalesce(F.sum("_mix_size").over(before), F.lit(0))
    part = part.withColumn("_mix_extra", F.greatest(F.lit(0), F.least(room, F.col("_mix_size"))).cast("long")).drop(
        "_mix_size")
    return whole.unionByName(part).drop("_mix_of", "_mix_source", "_mix_block", "_mix_left", "_mix_words")


def mixed(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: a row per drawn copy with all columns of ``df``, the
    text cut where a quota ends, plus ``_shard`` and ``_shuffle_key``. Rows of
    a shard sorted by ``_shuffle_key`` are the shard's order."""
    size = word_count(text_or_empty(text_col))
    sized = materialize(df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size")),
                        "sizes")
    got = draws(df, quotas(sized), size, id_col, source_col)
    got = got.select(*df.columns, "_mix_extra", "_mix_passes", F.posexplode("_mix_shards").alias("_mix_pass", "_shard"))
    extra, last = F.col("_mix_extra"), F.col("_mix_pass") >= F.col("_mix_passes")
    got = got.where(~last | extra.isNull() | (extra > 0))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"),
                                                    F.lit(0)), F.lit(1), F.greatest(extra, F.lit(1)).cast("int")), "")
    text = F.when(last & extra.isNotNull() & (extra < size), cut).otherwise(F.col(text_col))
    key = _hash("s", F.col("_shard"), _id(id_col), F.col("_mix_pass"))
    return got.withColumn("_shuffle_key", key).withColumn(text_col, text).drop(
        "_mix_extra", "_mix_passes", "_mix_pass")


def mix_report(df: DataFrame, id_col: str = "doc_id", source_col: str = "source",
               text_col: str = "text") -> DataFrame:
    """``doc_id, size, source_size, target, taken, shards`` per document."""
    sized = materialize(df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                  word_count(text_or_empty(text_col)).alias("size")), "sizes")
    got = draws(sized, quotas(sized), F.col("size"))
    shards, passes = F.coalesce(F.col("_mix_shards"), F.array().cast("array<bigint>")), F.col("_mix_passes")
    extra = F.when(F.size(shards) > passes, F.coalesce(F.col("_mix_extra"), F.col("size"))).otherwise(0)
    used = F.when(F.col("_mix_extra") <= 0, F.slice(shards, F.lit(1), passes)).otherwise(shards)
    return got.select(
        "doc_id", "size", F.col("_mix_source_size").alias("source_size"), F.round("_mix_target", 6).alias("target"),
        (passes * F.col("size") + extra).cast("long").alias("taken"),
        F.array_join(used.cast("array<string>"), ",").alias("shards"))


def _oracle() -> str:
    """The same mix in DuckDB."""
    h = lambda tag, *parts: "md5(concat_ws('|', '%s%s', %s))" % (SEED, tag, ", ".join(f"({p})::VARCHAR" for p in parts))
    name = "coalesce('s' || source, 'n')"
    tree = "t0 AS (SELECT source, block, unnest(range(0, n)) AS pass, 0 AS node FROM drawn WHERE n > 0)"
    for k in range(LEVELS):
        tree += (f", t{k + 1} AS (SELECT source, block, pass, node * 2 + CASE WHEN 2 * row_number() OVER (PARTITION BY node"
                 f" ORDER BY {h(f't{k}', name, 'block', 'pass')}) <= count(*) OVER (PARTITION BY node) + 1 THEN 0 ELSE 1 END"
                 f" AS node FROM t{k})")
    return f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr({h('d', "coalesce(doc_id::VARCHAR, 'n')")}, 1, 2))::INT AS block,
         {h('o', "coalesce(doc_id::VARCHAR, 'n')")} AS dkey
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, [{', '.join(f'{float(x)}' for x in WEIGHTS)}][
        1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)})::INT] AS w FROM s),
o AS (  -- sources by the level at which they reach the cap
  SELECT *, coalesce(sum(source_size) OVER (ORDER BY {CAP} * source_size / w, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(w) OVER (ORDER BY {CAP} * source_size / w, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w
  FROM w),
l AS (SELECT max(({SHARE}::DOUBLE * (SELECT sum(source_size) FROM s) - {CAP}::DOUBLE * held) / rest_w) AS lvl FROM o
      WHERE ({SHARE}::DOUBLE * (SELECT sum(source_size) FROM s) - {CAP}::DOUBLE * held) / rest_w * w
            < {CAP}::DOUBLE * source_size),
g AS (SELECT source, source_size, least({CAP}::DOUBLE * source_size, coalesce(lvl, 'infinity'::DOUBLE) * w) AS target
      FROM w, l),
q AS (SELECT *, CASE WHEN source_size > 0 THEN (floor(target + 0.5)::BIGINT // source_size)::INT ELSE 0 END AS passes
      FROM g),
b AS (SELECT source, block, sum(size)::BIGINT AS words FROM d GROUP BY source, block),
drawn0 AS (
  SELECT b.*, q.source_size, q.target, q.passes, floor(q.target + 0.5)::BIGINT - q.passes * q.source_size
         - coalesce(sum(words) OVER (PARTITION BY b.source ORDER BY {h('b', name.replace('source', 'b.source'), 'b.block')}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM b JOIN q ON b.source IS NOT DISTINCT FROM q.source),
drawn AS (SELECT *, passes + CASE WHEN room > 0 AND words > 0 THEN 1 ELSE 0 END AS n FROM drawn0),
{tree},
sh AS (SELECT source, block, list(node ORDER BY pass) AS shards FROM t{LEVELS} GROUP BY source, block),
f AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.passes, r.n, coalesce(sh.shards, []) AS shards,
         CASE WHEN r.room <= 0 THEN 0 ELSE greatest(0, least(d.size, r.room - coalesce(sum(d.size) OVER (
           PARTITION BY d.source, d.block ORDER BY d.dkey, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))
         END AS extra,
         r.room > 0 AND r.room < r.words AS ends, r.room > 0 AS open
  FROM d JOIN drawn r ON d.source IS NOT DISTINCT FROM r.source AND d.block = r.block
  LEFT JOIN sh ON sh.source IS NOT DISTINCT FROM r.source AND sh.block = r.block)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (passes * size + CASE WHEN n > passes THEN extra ELSE 0 END)::BIGINT AS taken,
       array_to_string(CASE WHEN NOT open OR (ends AND extra <= 0) THEN shards[1:passes] ELSE shards END, ',') AS shards
FROM f
"""


@register("op8_mixing", _oracle())
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))
