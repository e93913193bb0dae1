"""Exact k-nearest-neighbour join and KNN regression on DataFrames.

No cross join, no all-pairs step and no rounds. The plan:

1. **Collapse duplicates.** For any query, points with the same feature
   vector are equally far, so with ties broken by (distance, id) only the k
   smallest ids of each vector can ever be neighbours. ``row_number() <= k``
   per vector is planned as a WindowGroupLimit that also limits before the
   shuffle, so a vector holding a third of the rows costs k rows per task.
   Query vectors are de-duplicated the same way and joined back at the end.
2. **Pyramid of cell summaries.** Points are sorted along a Z-order curve over
   quantile-scaled coordinates (up to three features) and cut into leaves of
   ``leaf`` successive points, so a dense cluster has as many leaves as its
   points need. A leaf's summary is its bounding box over *all* features and its
   count; ``FANOUT`` successive summaries make a node of the level above.
3. **Bound.** Every query vector first walks down to one near leaf: level by
   level to the child whose nearest and farthest corner are nearest in sum,
   among those with k points. The farthest corner of a box with k points bounds the query's k-th distance, and
   so does the k-th distance to the points of the leaf reached.
4. **Descent.** The query starts at the top again and goes down to all children
   whose box comes at least as near as its bound, which every level tightens by
   its nearest farthest corner. The number of levels is known beforehand, and a
   level is one join on the node number.
5. **Top-k.** Query vectors meet the points of their remaining leaves only,
   drop those beyond the bound, and ``row_number() <= k`` by (distance, id)
   gives the result.

Box distances are computed by the same operations in the same order as point
distances, and rounding is monotone, so the bounds hold for the computed
values and the result is exact, ties included.

With ``exclude=(q_col, p_col)`` a point is a candidate only when the two
values differ (cross-validation folds in one join). A node then counts only
the points that are left whichever value is excluded, and a node all of whose
points have the query's own value is dropped.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathe.functions.columns import is_finite
from lathe.session import materialize

LEAF = 16  # points of a leaf, and at least so many as neighbours are asked for
FANOUT = 64  # nodes under a node
SCALE_CUTS = 32  # quantile segments of a curve coordinate
BITS = 16  # of a curve coordinate; three fit into a long
BROADCAST_BYTES = 8 << 20  # a level's summaries are broadcast up to this size


def _apart(p: int, terms: list[str]) -> str:
    """Ordering key of a difference vector: squares or magnitudes, summed in
    the order of the features (box bounds rely on that)."""
    if p not in (1, 2):
        raise ValueError("p must be 1 or 2")
    return " + ".join(f"({t}) * ({t})" if p == 2 else f"abs({t})" for t in terms)


def _near(p: int, feats: list[str], at: str = "") -> str:
    """Least ordering key of the box ``at`` holds."""
    return _apart(p, [f"greatest({at}`_lo_{f}` - `q_{f}`, 0D, `q_{f}` - {at}`_hi_{f}`)" for f in feats])


def _far(p: int, feats: list[str], at: str = "") -> str:
    """Ordering key of the box's farthest corner."""
    return _apart(p, [f"greatest(abs(`q_{f}` - {at}`_lo_{f}`), abs(`q_{f}` - {at}`_hi_{f}`))" for f in feats])


def _scaled(x: str, cuts: list[float]) -> Column:
    """Position of ``x`` among ascending ``cuts`` (linear between two), as an
    integer of ``BITS`` bits: a balanced tree of comparisons."""
    m, d = len(cuts) - 1, lambda v: f"CAST('{v!r}' AS DOUBLE)"
    if m < 1:
        return F.lit(0).cast("long")

    def part(lo: int, hi: int) -> str:
        if hi - lo == 1:
            width = cuts[hi] - cuts[lo]
            return f"{lo}D + " + (f"(`{x}` - {d(cuts[lo])}) / {d(width)}" if width < float("inf") else "0.5D")
        mid = (lo + hi) // 2
        return f"CASE WHEN `{x}` < {d(cuts[mid])} THEN {part(lo, mid)} ELSE {part(mid, hi)} END"

    return F.expr(f"CAST(least(greatest(floor(({part(0, m)}) / {m} * {1 << BITS}), 0), {(1 << BITS) - 1}) AS BIGINT)")


def _curve(cols: list[str]) -> Column:
    """Z-order value: the bits of the coordinates in turn."""
    return F.expr(" | ".join(f"shiftleft(shiftright(`{c}`, {b}) & 1L, {b * len(cols) + d})"
                             for b in range(BITS) for d, c in enumerate(cols)) or "0L")


def _collapsed(points: DataFrame, feats: list[str], k: int, pid: str, px: str | None) -> DataFrame:
    """Of each vector, the k smallest ids; with exclusion, k of each value and
    of these 2k, among which k are left whichever value is excluded."""
    def least(df, by, n):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(pid))
        return df.withColumn("_rn", rank).filter(F.col("_rn") <= n).drop("_rn")

    if px is None:
        return least(points, feats, k)
    return least(least(points, [*feats, px], k), feats, 2 * k)


def _bad(cols: list[str]) -> Column:
    return functools.reduce(lambda a, b: a | b, [~is_finite(F.col(c)) for c in cols])


def _measured(pts: DataFrame, feats: list[str]) -> tuple[int, list]:
    """Rows of the written points and their features' quantiles; raises where
    a feature is missing or infinite."""
    steps = [i / SCALE_CUTS for i in range(SCALE_CUTS + 1)]
    cols = [f"p_{f}" for f in feats]
    row = pts.agg(F.count(F.lit(1)), F.count(F.when(_bad(cols), 1)), *[F.percentile_approx(c, steps, 1000) for c in cols]).first()
    if row[1]:
        raise ValueError(f"points have missing or infinite values in {feats}: fill or drop those rows first")
    return row[0], [sorted(set(q or [])) for q in row[2:]]


def _pyramid(pts: DataFrame, n: int, feats: list[str], coords: list[Column], px: str | None,
             leaf: int) -> tuple[DataFrame, list[DataFrame], list[int]]:
    """Points with their ``_leaf``, the summaries of each level (leaves
    first, the last with at most ``FANOUT`` nodes) and bounds of their sizes."""
    spark = pts.sparkSession
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // (8 * leaf)))
    order = ["_z", *[f"p_{f}" for f in feats]]
    # the id's upper half is the range partition, its lower half the row's place in it
    # coordinates are columns of their own: each bit of the curve refers to them
    at = {f"_u{d}": c for d, c in enumerate(coords)}
    lined = pts.withColumns(at).withColumn("_z", _curve(list(at))).drop(*at)
    lined = materialize(lined.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                        .withColumn("_at", F.monotonically_increasing_id()), "knn-points")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    lined = lined.withColumns({"_pid": F.shiftright("_at", 33), "_j": F.floor(place / leaf)})
    bounds = [a for f in feats for a in (F.min(f"p_{f}").alias(f"_lo_{f}"), F.max(f"p_{f}").alias(f"_hi_{f}"))]
    value = [F.col(f"p_{px}").alias("_value")] if px else []
    base = materialize(lined.groupBy("_pid", "_j", *value).agg(F.count(F.lit(1)).alias("_c"), *bounds), "knn-leaves")
    # leaves are numbered in order of the curve; a range with fewer leaves leaves numbers out
    most, ranges = base.agg(F.coalesce(F.max("_j") + 1, F.lit(1)), F.coalesce(F.max("_pid") + 1, F.lit(1))).first()
    number = F.col("_pid") * F.lit(most) + F.col("_j")
    base = base.withColumn("_leaf", number).drop("_pid", "_j")
    lined = lined.withColumn("_leaf", number).drop("_pid", "_j", "_z", "_at")
    sizes = [most * ranges]

    wider = [a for f in feats for a in (F.min(f"_lo_{f}").alias(f"_lo_{f}"), F.max(f"_hi_{f}").alias(f"_hi_{f}"))]
    single = F.count(F.lit(1)) == 1
    left = F.when(single, F.sum("_c")).otherwise(F.sum("_c") - F.max("_c")).alias("_count")
    levels = []
    while True:
        node = F.floor(F.col("_leaf") / FANOUT ** len(levels)).alias("_node")
        cells = base.withColumn("_node", node).drop("_leaf")
        if levels:  # a leaf's rows are one by value already
            cells = cells.groupBy("_node", *(["_value"] if px else [])).agg(F.sum("_c").alias("_c"), *wider)
        if px:  # the points left whichever value is excluded; all of them where there is one value
            cells = cells.groupBy("_node").agg(left, single.alias("_single"), F.any_value("_value").alias("_value"), *wider)
        levels.append(cells if px else cells.withColumnRenamed("_c", "_count"))
        if sizes[-1] <= FANOUT:
            break
        sizes.append(-(-sizes[-1] // FANOUT))
    return lined, levels, sizes


def knn_candidates(queries: DataFrame, points: DataFrame, features: list[str], k: int = 5, p: int = 2,
                   pid: str = "pid", payload: list[str] = (), exclude: tuple[str, str] | None = None,
                   grid_dims: list[str] | None = None, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """The distinct query vectors with their number ``_vid``, and the (vector,
    point) pairs that the descent leaves, with the ordering key ``_ok``."""
    feats, leaf = list(features), max(leaf, k)
    qx, px = (exclude or (None, None))
    as_double = lambda df: df.withColumns({f: F.col(f).cast("double") for f in feats})
    keep = list(dict.fromkeys([pid, *feats, *payload, *([px] if px else [])]))
    pts = _collapsed(as_double(points.select(*keep)), feats, k, pid, px)
    pts = materialize(pts.select(*[F.col(c).alias(f"p_{c}") for c in pts.columns]), "knn-collapsed")
    n, cuts = _measured(pts, feats)
    qkey = list(dict.fromkeys([*feats, *([qx] if qx else [])]))
    qv = as_double(queries.select(*qkey)).distinct().select(*[F.col(c).alias(f"q_{c}") for c in qkey])
    # narrow rows with much work each: kept apart, where adaptive execution would merge them by size
    qv = qv.repartition(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spans = {f: (c[-1 - len(c) // 20] - c[len(c) // 20]) if len(c) > 1 else 0.0 for f, c in zip(feats, cuts)}
    dims = list(grid_dims) if grid_dims else sorted(feats, key=lambda f: (-spans[f], feats.index(f)))[:3]
    coords = [_scaled(f"p_{f}", cuts[feats.index(f)]) for f in dims]
    lined, levels, sizes = _pyramid(pts, n, feats, coords, px, leaf)

    fixed = not exclude or not isinstance(points.schema[px].dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType))
    row_bytes = 16 * len(feats) + 64
    down = []  # levels from the top, each with the number of the node above
    for at, (level, size) in enumerate(zip(reversed(levels), reversed(sizes))):
        level = level.withColumn("_above", F.floor(F.col("_node") / FANOUT))  # of the top's at most ``FANOUT`` nodes: 0
        # a proven size: the summaries are counted and of fixed width
        down.append((level, at == 0 or (fixed and size * row_bytes <= BROADCAST_BYTES)))
    small = lambda df, yes: F.broadcast(df) if yes else df
    own = lambda at: f"({at}_single AND {at}_value <=> `q_{qx}`)" if exclude else "false"

    front = qv
    # the top is above number 0, computed: a literal would leave a join without a key
    top = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(1))
    seek = front.withColumns({"_at": top(*front.columns), "_bound": F.lit(float("inf"))})
    for level, few in down:
        kids = level.groupBy("_above").agg(F.collect_list(F.struct(*[c for c in level.columns if c != "_above"])).alias("_kids"))
        best = F.expr(f"array_min(transform(filter(_kids, c -> c._count >= {k} AND NOT {own('c.')}), "
                      f"c -> struct({_near(p, feats, 'c.')} + {_far(p, feats, 'c.')} AS sum, {_far(p, feats, 'c.')} AS far, c._node AS node)))")
        seek = seek.join(small(kids, few), seek["_at"] == kids["_above"], "left").withColumn("_best", best)
        seek = seek.select(*front.columns, F.col("_best.node").alias("_at"),  # null: no child has k points, the walk ends
                           F.least("_bound", F.coalesce("_best.far", F.lit(float("inf")))).alias("_bound"))
    held = [*[F.col(f"p_{f}") for f in feats], *([F.col(f"p_{px}").alias("_value")] if px else [])]
    heap = lined.groupBy("_leaf").agg(F.collect_list(F.struct(*held)).alias("_points"))  # at most ``leaf`` points
    apart = _apart(p, [f"`q_{f}` - x.`p_{f}`" for f in feats])
    keys = f"transform(filter(_points, x -> NOT x._value <=> `q_{qx}`), x -> {apart})" if exclude else f"transform(_points, x -> {apart})"
    seek = seek.join(heap, seek["_at"] == heap["_leaf"], "left").withColumn("_keys", F.expr(f"array_sort({keys})"))
    kth = F.coalesce(F.get("_keys", F.lit(k - 1)), F.lit(float("inf")))
    # written, so a vector's number is the same in every use
    vectors = materialize(seek.select(F.monotonically_increasing_id().alias("_vid"), *front.columns,
                                      F.least("_bound", kth).alias("_bound")), "knn-bounds")
    front = vectors.withColumn("_at", top("_vid"))
    if front.where(_bad([f"q_{f}" for f in feats])).limit(1).count():
        raise ValueError(f"queries have missing or infinite values in {feats}: fill or drop those rows first")
    # dealt by vector once: broadcast levels keep that, so the windows shuffle nothing
    front = front.repartition(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_vid")
    mine = Window.partitionBy("_vid")
    for level, few in down:
        met = front.join(small(level, few), F.col("_at") == F.col("_above"))
        met = met.where(f"NOT {own('')}").withColumn("_near", F.expr(_near(p, feats)))
        enough = F.min(F.expr(f"CASE WHEN _count >= {k} THEN {_far(p, feats)} END")).over(mine)
        met = met.where("_near <= _bound").withColumn("_bound", F.least("_bound", F.coalesce(enough, F.lit(float("inf")))))
        front = met.where("_near <= _bound").select(*[c for c in front.columns if c != "_at"], F.col("_node").alias("_at"))
    pairs = front.join(lined, F.col("_at") == F.col("_leaf"))
    if exclude:
        pairs = pairs.filter(~F.col(f"q_{qx}").eqNullSafe(F.col(f"p_{px}")))
    pairs = pairs.withColumn("_ok", F.expr(_apart(p, [f"`q_{f}` - `p_{f}`" for f in feats])))
    return vectors.select("_vid", *[f"q_{c}" for c in qkey]), pairs.filter(F.col("_ok") <= F.col("_bound"))


def knn_join(queries: DataFrame, points: DataFrame, features: list[str], k: int = 5, p: int = 2,
             qid: str = "qid", pid: str = "pid", payload: list[str] = (), exclude: tuple[str, str] | None = None,
             grid_dims: list[str] | None = None, leaf: int = LEAF) -> DataFrame:
    """For every query row, its k nearest points by (distance, point id).

    ``queries`` holds ``qid`` and the features (plus the exclusion column);
    ``points`` holds ``pid``, the features and ``payload`` columns. Output:
    ``qid, pid, distance, rank`` (1..k) and the payload. Feature values must
    be finite numbers. Fewer than k rows come back only when fewer candidates
    exist. ``grid_dims`` names the features the curve runs over.
    """
    feats, qx = list(features), exclude[0] if exclude else None
    vectors, pairs = knn_candidates(queries, points, feats, k, p, pid, payload, exclude, grid_dims, leaf)
    first = Window.partitionBy("_vid").orderBy("_ok", f"p_{pid}")
    best = (pairs.select("_vid", f"p_{pid}", *[f"p_{c}" for c in payload if c != pid], "_ok")
            .withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k))
    best = best.withColumn("distance", F.sqrt("_ok") if p == 2 else F.col("_ok"))
    # back to query rows
    rows = queries.select(F.col(qid).alias("_qid"), *[F.col(f).cast("double").alias(f"_{f}") for f in feats],
                          *([F.col(qx).alias("_value")] if qx else []))
    same = [F.col(f"_{f}") == F.col(f"q_{f}") for f in feats]
    same += [F.col("_value").eqNullSafe(F.col(f"q_{qx}"))] if qx else []
    rows = rows.join(vectors, functools.reduce(lambda a, b: a & b, same)).select("_qid", "_vid")
    return rows.join(best, "_vid").select(F.col("_qid").alias(qid), F.col(f"p_{pid}").alias(pid), "distance", "rank",
                                          *[F.col(f"p_{c}").alias(c) for c in payload])


def knn_regress(neighbours: DataFrame, qid: str, target: str, weights: str = "uniform",
                out: str = "prediction") -> DataFrame:
    """Mean neighbour target per query. ``distance`` weights are 1/d; if any
    neighbour is at distance 0, only those count, equally."""
    if weights == "uniform":
        return neighbours.groupBy(qid).agg(F.avg(target).alias(out))
    if weights != "distance":
        raise ValueError("weights must be 'uniform' or 'distance'")
    zero = F.col("distance") == 0
    agg = neighbours.groupBy(qid).agg(
        F.sum(F.when(zero, 1).otherwise(0)).alias("_nz"),
        F.avg(F.when(zero, F.col(target))).alias("_zmean"),
        F.sum(F.when(~zero, F.col(target) / F.col("distance"))).alias("_wy"),
        F.sum(F.when(~zero, 1.0 / F.col("distance"))).alias("_w"),
    )
    return agg.select(qid, F.when(F.col("_nz") > 0, F.col("_zmean")).otherwise(F.col("_wy") / F.col("_w")).alias(out))
