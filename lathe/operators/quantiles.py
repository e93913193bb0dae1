"""Exact quantiles with linear interpolation (pandas / numpy default).

One plan for every size and number of columns (``exact``): one pass turns all
columns into (column, value, count) rows, so a hot value costs one row; these
are range-partitioned by (column, value); counts per range (a row per range)
reach the driver; and only the ranges that hold wanted order statistics are
ranked, each by a task that holds one range.

``percentile`` is Spark's own exact aggregate (its value→count map is merged
in one task: for columns known to have few values); ``approx`` is its
one-pass sketch and not exact. Both are opt-in.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lathe.functions.columns import missing
from lathe.session import materialize

def quantiles(df: DataFrame, cols: list[str], qs: list[float], method: str = "exact",
              buckets: int | None = None) -> dict[str, list[float | None]]:
    """``{col: [quantile per q]}``; missing values (NULL/NaN) are skipped.
    ``buckets``: ranges of the exact plan (default: the shuffle partitions)."""
    if method == "exact":
        return _exact(df, cols, qs, buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if method == "percentile":
        aggs = []
        for c in cols:
            v = F.when(~missing(c), F.col(c).cast("double"))
            aggs.append(F.percentile(v, F.array(*[F.lit(float(q)) for q in qs])).alias(c))
        row = df.agg(*aggs).first()
        return {c: (list(row[c]) if row[c] is not None else [None] * len(qs)) for c in cols}
    if method == "approx":  # opt-in: Greenwald–Khanna sketch, one pass, not exact
        row = df.agg(*[F.percentile_approx(F.when(~missing(c), F.col(c).cast("double")), list(qs), 10_000).alias(c)
                       for c in cols]).first()
        return {c: (list(row[c]) if row[c] is not None else [None] * len(qs)) for c in cols}
    raise ValueError(f"unknown quantile method {method}")


def _exact(df: DataFrame, cols: list[str], qs: list[float], ranges: int) -> dict[str, list[float | None]]:
    value = lambda i, c: F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v"))
    long = df.select(F.explode(F.array(*[value(i, c) for i, c in enumerate(cols)])).alias("x")).select("x.*")
    dist = (long.where(~missing("v")).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
            .repartitionByRange(ranges, "c", "v").withColumn("part", F.spark_partition_id()))
    dist = materialize(dist, "quantiles")
    sizes = sorted((r["c"], r["part"], r["n"]) for r in dist.groupBy("c", "part").agg(F.sum("n").alias("n")).collect())
    wanted, points = {}, {}  # (column, range) -> offsets; (column, q) -> positions and fraction
    for i in range(len(cols)):
        own = [(part, n) for c, part, n in sizes if c == i]
        total = sum(n for _, n in own)
        for q in qs if total else []:
            h = (total - 1) * q
            points[i, q] = (math.floor(h), min(math.floor(h) + 1, total - 1), h - math.floor(h))
            for pos in points[i, q][:2]:
                start = 0
                for part, n in own:
                    if start <= pos < start + n:
                        wanted.setdefault((i, part), {})[pos - start] = pos
                    start += n
    found = {}
    if wanted:
        # the wanted offsets (columns x quantiles) as an inline table: a long predicate would not be planned
        values = ", ".join(f"({c}, {part}, {off}L)" for (c, part), offs in wanted.items() for off in offs)
        want = F.broadcast(df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(c, part, off)"))
        w = Window.partitionBy("c", "part").orderBy("v")
        ranked = (dist.join(want.select("c", "part").distinct(), ["c", "part"], "left_semi")
                  .withColumn("end", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))))
        holds = (F.col("end") > F.col("off")) & (F.col("end") - F.col("n") <= F.col("off"))
        for r in ranked.join(want, ["c", "part"]).where(holds).select("c", "part", "off", "v").collect():
            found[r["c"], wanted[r["c"], r["part"]][r["off"]]] = r["v"]
    def at(i: int, q: float) -> float | None:
        if (i, q) not in points:
            return None
        lo, hi, frac = points[i, q]
        return found[i, lo] + (found[i, hi] - found[i, lo]) * frac

    return {c: [at(i, q) for q in qs] for i, c in enumerate(cols)}


def grouped_quantiles(df: DataFrame, by: list[str], col: str, qs: list[float], names: list[str] | None = None,
                      buckets: int | None = None) -> DataFrame:
    """Exact per-group quantiles (linear interpolation) from one scan, with
    bounded work per task, also when one group holds a third of the rows:

    1. rows collapse to (group, value, count), so a hot value is one row, which
       is range-partitioned by (group, value) and written once;
    2. running counts over the rows per (group, range) (a group has at most a
       row per range) locate the range of each wanted order statistic;
    3. only those ranges of the written order are ranked, a window each.

    There are ``buckets`` ranges, by default ``spark.sql.shuffle.partitions``.
    Returns ``by`` + one column per q; a null key is a group of its own, a
    group without values has no row."""
    names = names or [f"q{i}" for i in range(len(qs))]
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = (df.filter(~missing(col)).groupBy(*by, F.col(col).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
              .repartitionByRange(n, *by, "_v").withColumn("_part", F.spark_partition_id()))
    counts = materialize(counts, "value-counts")
    group = Window.partitionBy(*by)
    before = F.sum("_m").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_m")
    parts = counts.groupBy(*by, "_part").agg(F.sum("_c").alias("_m")).select(
        *by, "_part", "_m", before.alias("_start"), F.sum("_m").over(group).alias("_n"))
    wanted = []  # positions around each quantile
    for i, q in enumerate(qs):
        h = (F.col("_n") - 1) * F.lit(float(q))
        for side, at in ((0, F.floor(h)), (1, F.least(F.floor(h) + 1, F.col("_n") - 1))):
            wanted.append(F.struct(F.lit(i).alias("qi"), F.lit(side).alias("side"), (at - F.col("_start")).alias("at"),
                                   (h - F.floor(h)).alias("frac")))
    need = parts.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("_part").alias("_k_part"), F.filter(
        F.array(*wanted), lambda t: (t["at"] >= 0) & (t["at"] < F.col("_m"))).alias("_t")).where(F.size("_t") > 0)
    here = F.col("_part") == F.col("_k_part")
    for c in by:
        here &= F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    upto = F.sum("_c").over(Window.partitionBy(*by, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    met = (counts.join(need, here).withColumn("_hi", upto)
           .withColumn("_t", F.filter("_t", lambda t: (t["at"] >= F.col("_hi") - F.col("_c")) & (t["at"] < F.col("_hi"))))
           .select(*by, "_v", F.explode("_t").alias("_t")))
    picked = lambda i, side, value: F.max(F.when((F.col("_t.qi") == i) & (F.col("_t.side") == side), value))
    found = met.groupBy(*by).agg(*[a for i in range(len(qs)) for a in (
        picked(i, 0, F.col("_v")).alias(f"_a{i}"), picked(i, 1, F.col("_v")).alias(f"_b{i}"),
        picked(i, 0, F.col("_t.frac")).alias(f"_f{i}"))])
    return found.select(*by, *[(F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * F.col(f"_f{i}")).alias(name)
                               for i, name in enumerate(names)])
