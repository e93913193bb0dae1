"""Gradient-boosted regression trees by second-order histograms.

The training rows are binned once (cut points per feature) and written as a
narrow table: target, margin, row key, bin numbers. A level of a tree is one
job over it:

* each task adds the gradients and rows of its share by (node, feature, bin)
  in numpy; what leaves a task is at most nodes x features x bins rows;
* they are summed by (node, feature, bin) in one grouped aggregate;
* the driver reads these sums (bounded by the parameters; wide tables are read
  in slices of features, at most ``MAX_CELLS`` sums at a time) and finds each
  node's best cut from their prefix sums.

Several models can be fitted at once over the same binned table; a pass then
serves the next level of each.

Gradients are rounded to fixed-point integers before they are summed, so sums
are exact: a fit does not depend on partitions, task order or retries, and the
same formulas in SQL give the same trees. Margins are written every
``REFRESH`` trees; until then a task adds the trees since the last write.

The objective is squared error with L1 and L2 penalties on leaf weights:
``weight = -soft(G, alpha) / (H + lambda)``. Trees grow by level to
``max_depth``, or leaf by leaf (best gain first) to ``num_leaves``. Leaf-wise
growth is evaluated in levels too: a node's best cut does not depend on when
it is taken, so only nodes that the best-first order reaches are expanded.

Column sampling is drawn per tree, row sampling per tree from a hash of
(row key, tree); ``subsample_freq = 0`` draws no rows, whatever ``subsample``.

Defined results: rows without a target (NULL, NaN) are left out of the fit; a
missing feature value lies below all cuts; equal gains go to the first feature,
then the smallest cut; an empty training set raises.
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.functions.columns import missing
from lathe.operators.quantiles import quantiles
from lathe.session import materialize

REFRESH = 10  # trees between two writes of the margins
MAX_DEPTH = 30
MAX_CELLS = 2_000_000  # sums read by the driver at a time
TASK_ROWS = (8_192, 500_000)  # least and most rows of a task of a pass
COMPILED_NODES = 400  # tree nodes of a model up to which its expression is compiled


@dataclass
class BoostParams:
    n_estimators: int = 50
    max_depth: int = 6  # negative: MAX_DEPTH
    learning_rate: float = 0.1
    subsample: float = 1.0
    subsample_freq: int = 1  # trees between two draws of rows; 0: never
    colsample_bytree: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    num_leaves: int | None = None  # given: leaf-wise growth
    min_child_rows: int = 1
    max_bins: int = 256
    binning: str = "exact"  # or "sketch": quantiles of columns with many values in one pass, not exact
    seed: int = 42

    def depth(self) -> int:
        return MAX_DEPTH if self.max_depth < 0 else min(self.max_depth, MAX_DEPTH)


@dataclass
class Booster:
    """A fitted model: ``trees[t][node]`` is ``(feature, cut, None)`` for a
    split (value <= cut goes to node 2n, the rest to 2n + 1) or ``(None, None,
    weight)`` for a leaf; the root is node 1."""

    features: list[str]
    base: float
    trees: list[dict] = field(default_factory=list)
    params: dict = field(default_factory=dict)


# ------------------------------------------------------------------ bins
def cut_points(df: DataFrame, features: list[str], max_bins: int, binning: str = "exact") -> list[list[float]]:
    """Ascending cuts per feature: every value but the largest where a column
    has at most ``max_bins`` values, else its quantiles at i / max_bins."""
    value = lambda i, c: F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v"))
    long = df.select(F.explode(F.array(*[value(i, c) for i, c in enumerate(features)])).alias("x")).select("x.*")
    long = long.where(~missing("v"))
    few = long.groupBy("c").agg(F.approx_count_distinct("v", 0.02).alias("n"))
    short = {r["c"] for r in few.collect() if r["n"] <= 1.2 * max_bins + 2}  # a row per feature
    cuts: list[list[float] | None] = [None] * len(features)
    if short:
        values: dict[int, list[float]] = {i: [] for i in short}
        for r in long.where(F.col("c").isin(sorted(short))).distinct().collect():  # bounded: few values each
            values[r["c"]].append(r["v"] + 0.0)
        for i, vs in values.items():
            if len(set(vs)) <= max_bins:
                cuts[i] = sorted(set(vs))[:-1]
    rest = [c for i, c in enumerate(features) if cuts[i] is None]
    if rest:
        steps = [i / max_bins for i in range(1, max_bins)]
        got = quantiles(df, rest, steps, "exact" if binning == "exact" else "approx")
        for c in rest:
            cuts[features.index(c)] = sorted({x for x in got[c] if x is not None})
    return [c or [] for c in cuts]


def _binned(df: DataFrame, features: list[str], cuts: list[list[float]]) -> DataFrame:
    """``y, key, bins`` of each row; a bin is the number of cuts below
    the value, 0 where it is missing."""
    edges = [np.array(c) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2).values.to_numpy(zero_copy_only=False).reshape(b.num_rows, len(edges))
            bins = np.empty(x.shape, np.int16)
            for f, e in enumerate(edges):
                bins[:, f] = np.where(np.isnan(x[:, f]), 0, np.searchsorted(e, x[:, f]))
            at = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(edges))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(at, pa.array(bins.ravel()))], names=["y", "key", "bins"])

    nan = F.lit(float("nan"))
    values = F.array(*[F.coalesce(F.col(f), nan) for f in features])
    return df.select(F.col("_y").alias("y"), F.col("_key").alias("key"), values.alias("x")).mapInArrow(
        run, "y double, key long, bins array<smallint>")


# ------------------------------------------------------------------ trees
def soft(g, alpha: float):
    """The sum of gradients after the L1 penalty."""
    return g - alpha if g > alpha else g + alpha if g < -alpha else 0.0


def _descend(bins: np.ndarray, routes: list[tuple]) -> np.ndarray:
    node = np.ones(len(bins), np.int64)
    for n, f, b in routes:
        here = np.flatnonzero(node == n)
        node[here] = 2 * n + (bins[here, f] > b)
    return node


def _leaf_values(node: np.ndarray, leaves: list[tuple]) -> np.ndarray:
    ids, values = np.array([n for n, _ in leaves]), np.array([v for _, v in leaves])
    order = np.argsort(ids)
    return values[order][np.searchsorted(ids[order], node)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: even bits from any key."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def drawn_rows(key: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Which rows a tree is grown on."""
    start = np.array([tree * 0x9E3779B9 + seed], np.uint64)
    return (_mix(key.astype(np.uint64) ^ _mix(start)) >> np.uint64(11)) < share * float(1 << 53)


def _unpack(b: pa.RecordBatch, done: list[list[tuple]]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Target, each model's margin after the trees of its ``done``, key and
    bins of a batch."""
    n = b.num_rows
    bins = b.column(3).values.to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 1), np.int16)
    margins = b.column(1).values.to_numpy(zero_copy_only=False).reshape(n, len(done)).T.copy() if n else np.empty((len(done), 0))
    for own, trees in zip(margins, done):
        for routes, leaves in trees:
            own += _leaf_values(_descend(bins, routes), leaves)
    return b.column(0).to_numpy(zero_copy_only=False), list(margins), b.column(2).to_numpy(zero_copy_only=False), bins


ROWS = "y double, margins array<double>, key long, bins array<smallint>"


def _sums(rows: DataFrame, done: list[list[tuple]], asks: list[tuple], n_bins: int, scale: float) -> DataFrame:
    """``m, node, f, bin, g, n``: each task's sums over its rows. An ask is
    (model, routes so far, nodes, features, row draw)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros((len(feats), len(nodes) * n_bins), np.int64), np.zeros((len(feats), len(nodes) * n_bins), np.int64))
                for _, _, nodes, feats, _ in asks]
        for b in batches:
            y, margins, key, bins = _unpack(b, done)
            for (m, routes, nodes, feats, draw), (g_sum, n_sum) in zip(asks, held):
                node, wanted, size = _descend(bins, routes), np.array(nodes), n_sum.shape[1]
                at = np.searchsorted(wanted, node)
                here = (at < len(wanted)) & (wanted[np.minimum(at, len(wanted) - 1)] == node)
                if draw:
                    here &= drawn_rows(key, *draw)
                g = np.floor((margins[m][here] - y[here]) * scale + 0.5).astype(np.int64)
                high, low = g >> 20, g & 0xFFFFF  # each sums without rounding in a double
                cell = at[here] * n_bins
                for i, f in enumerate(feats):
                    c = cell + bins[here, f]
                    g_sum[i] += (np.bincount(c, high, size).astype(np.int64) << 20) + np.bincount(c, low, size).astype(np.int64)
                    n_sum[i] += np.bincount(c, minlength=size)
        for (m, _, nodes, feats, _), (g_sum, n_sum) in zip(asks, held):
            i, c = np.nonzero(n_sum)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), m, np.int32)), pa.array(np.array(nodes)[c // n_bins]),
                 pa.array(np.array(feats, np.int32)[i]), pa.array((c % n_bins).astype(np.int32)), pa.array(g_sum[i, c]),
                 pa.array(n_sum[i, c])], names=["m", "node", "f", "bin", "g", "n"])

    return rows.mapInArrow(run, "m int, node long, f int, bin int, g long, n long")


def _best_cuts(rows: DataFrame, fits: list, asks: list[tuple], n_bins: int, scale: float) -> dict[tuple, tuple]:
    """Best cut by (model, node): (feature, bin, gain, left g, left n, g, n);
    without a gain above 0 the feature is None."""
    out: dict[tuple, tuple] = {}
    width = max(len(a[3]) for a in asks)
    step = max(1, MAX_CELLS // max(1, sum(len(a[2]) for a in asks) * n_bins))
    for lo in range(0, width, step):  # a slice of the features at a time bounds what reaches the driver
        part = [(m, routes, nodes, feats[lo:lo + step], draw) for m, routes, nodes, feats, draw in asks if feats[lo:lo + step]]
        got = _sums(rows, [f.pending for f in fits], part, n_bins, scale).groupBy("m", "node", "f", "bin").agg(
            F.sum("g").alias("g"), F.sum("n").alias("n")).toArrow()
        col = {c: got.column(c).to_numpy() for c in got.column_names}
        for m, _, nodes, feats, _ in part:
            here = col["m"] == m
            g, n = np.zeros((2, len(nodes), len(feats), n_bins), np.int64)
            at = (np.searchsorted(nodes, col["node"][here]), np.searchsorted(feats, col["f"][here]), col["bin"][here])
            g[at], n[at] = col["g"][here], col["n"][here]
            for node, cut in zip(nodes, _choose(g, n, feats, fits[m].p, scale)):
                old = out.get((m, node))
                if old is None or (cut[0] is not None and (old[0] is None or cut[2] > old[2])):
                    out[m, node] = cut
    return out


def _choose(g: np.ndarray, n: np.ndarray, feats: list[int], p: BoostParams, scale: float) -> list[tuple]:
    """Best cut of each node from its (feature, bin) sums."""
    gl, nl = g.cumsum(-1), n.cumsum(-1)
    gt, nt = gl[..., -1:], nl[..., -1:]

    def score(g, n):
        g = g / scale
        s = np.where(g > p.reg_alpha, g - p.reg_alpha, np.where(g < -p.reg_alpha, g + p.reg_alpha, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            return s * s / (n + p.reg_lambda)

    gain = score(gl, nl) + score(gt - gl, nt - nl) - score(gt, nt)
    ok = (n > 0) & (nl >= p.min_child_rows) & (nt - nl >= p.min_child_rows) & (nl < nt) & (gain > 0)
    gain = np.where(ok, gain, -1.0).reshape(len(g), -1)
    best = gain.argmax(1)  # the first: smallest feature, then smallest bin
    out = []
    for i, c in enumerate(best):
        f, b = divmod(int(c), g.shape[2])
        total = (int(gt[i, 0, 0]), int(nt[i, 0, 0]))
        out.append((feats[f], b, float(gain[i, c]), int(gl[i, f, b]), int(nl[i, f, b]), *total) if gain[i, c] > 0
                   else (None, None, 0.0, 0, 0, *total))
    return out


def _taken(found: dict[int, tuple], depth: int, num_leaves: int | None) -> list[int]:
    """Nodes that are split, as far as cuts are known: all, or the first
    ``num_leaves - 1`` in best-first order."""
    can = {n for n, s in found.items() if s[0] is not None and n.bit_length() <= depth}
    if num_leaves is None:
        return sorted(can)
    out, heap = [], [(-found[1][2], 1)] if 1 in can else []
    while heap and len(out) < num_leaves - 1:
        _, n = heapq.heappop(heap)
        out.append(n)
        for c in (2 * n, 2 * n + 1):
            if c in can:
                heapq.heappush(heap, (-found[c][2], c))
    return sorted(out)


class _Fit:
    """One model while it grows: the cuts found for its current tree and the
    nodes whose cuts it needs next."""

    def __init__(self, p: BoostParams, features: list[str], base: float):
        self.p, self.model, self.pending = p, Booster(list(features), base, [], asdict(p)), []
        self.found, self.open = {}, [1] if p.n_estimators else []

    def ask(self, m: int) -> tuple:
        t, p = len(self.model.trees), self.p
        draw = (t // p.subsample_freq, p.seed, p.subsample) if p.subsample_freq and p.subsample < 1 else None
        routes = sorted((n, s[0], s[1]) for n, s in self.found.items() if s[0] is not None)
        return m, routes, self.open, tree_columns(p, len(self.model.features), t), draw

    def take(self, cuts: dict[int, tuple], edges: list[list[float]], scale: float) -> None:
        p = self.p
        self.found.update({n: cuts.get(n, (None, None, 0.0, 0, 0, 0, 0)) for n in self.open})
        taken = _taken(self.found, p.depth(), p.num_leaves)
        self.open = sorted(c for n in taken for c in (2 * n, 2 * n + 1)
                           if c not in self.found and c.bit_length() <= p.depth())
        if self.open:
            return
        stats, tree = {1: self.found[1][5:]}, {}
        for n in taken:  # ascending: parents first
            f, b, _, gl, nl, g, k = self.found[n]
            tree[n] = (f, b)
            stats[2 * n], stats[2 * n + 1] = (gl, nl), (g - gl, k - nl)
        leaves = [(n, -soft(g / scale, p.reg_alpha) / (k + p.reg_lambda) * p.learning_rate if k + p.reg_lambda > 0 else 0.0)
                  for n, (g, k) in sorted(stats.items()) if n not in tree]
        self.pending.append(([(n, *tree[n]) for n in sorted(tree)], leaves))
        names = self.model.features
        self.model.trees.append({**{n: (names[f], edges[f][b], None) for n, (f, b) in tree.items()},
                                 **{n: (None, None, v) for n, v in leaves}})
        self.found, self.open = {}, [1] if len(self.model.trees) < p.n_estimators else []


def tree_columns(p: BoostParams, n_features: int, tree: int) -> list[int]:
    """Features that a tree may split on, drawn by (seed, tree)."""
    k = max(1, math.floor(p.colsample_bytree * n_features + 1e-9))
    return sorted(random.Random(p.seed * 1_000_003 + tree).sample(range(n_features), k))


def fit_booster(df: DataFrame, features: list[str], target: str, params: BoostParams | None = None,
                row_key: list[str] | None = None) -> Booster:
    """One model; see ``fit_boosters``."""
    return fit_boosters(df, features, target, [params or BoostParams()], row_key)[0]


def fit_boosters(df: DataFrame, features: list[str], target: str, params: list[BoostParams],
                 row_key: list[str] | None = None) -> list[Booster]:
    """Models of several parameter sets fitted over one binned table: every
    pass serves the next level of all models that still grow, so a search
    takes as many passes as its longest fit. Each model equals its own fit
    alone. ``row_key`` names the columns that row sampling hashes."""
    if len({(p.max_bins, p.binning) for p in params}) != 1:
        raise ValueError("models of one fit share their bins: equal max_bins and binning")
    if any(p.subsample < 1 and p.subsample_freq for p in params) and not row_key:
        raise ValueError("row sampling needs row_key")
    # the fit passes over its input many times: the pruned rows are written once
    key = F.xxhash64(*row_key) if row_key else F.lit(0).cast("long")
    df = materialize(df.where(~missing(F.col(target).cast("double"))).select(
        *[F.col(f).cast("double").alias(f) for f in features], F.col(target).cast("double").alias("_y"), key.alias("_key")),
        "boost-input")
    edges = cut_points(df, features, params[0].max_bins, params[0].binning)
    rows = materialize(_dealt(_binned(df, features, edges), df.count()), "boost-rows")
    n, most = rows.agg(F.count(F.lit(1)), F.max(F.abs("y"))).first()
    if not n:
        raise ValueError("no training rows with a target")
    scale = 2.0 ** min(16, 61 - math.ceil(math.log2(2.0 * n * max(most, 1.0))))
    total = rows.agg(F.sum(F.floor(F.col("y") * F.lit(scale) + 0.5).cast("long"))).first()[0]
    base = total / n / scale
    fits = [_Fit(p, features, base) for p in params]
    rows = rows.select("y", F.array(*[F.lit(base)] * len(fits)).alias("margins"), "key", "bins")
    n_bins = max(len(c) for c in edges) + 1
    while any(f.open for f in fits):
        asks = [f.ask(m) for m, f in enumerate(fits) if f.open]
        cuts = _best_cuts(rows, fits, asks, n_bins, scale)
        for m, *_ in asks:
            fits[m].take({node: c for (k, node), c in cuts.items() if k == m}, edges, scale)
        if any(len(f.pending) >= REFRESH for f in fits) and any(f.open for f in fits):
            rows = materialize(_with_margins(rows, [f.pending for f in fits]), "boost-margins")
            for f in fits:
                f.pending = []
    return [f.model for f in fits]


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows in even parts for every core: narrow rows with much work each
    fit into few files, which would be few tasks in every pass."""
    least, most = TASK_ROWS
    parts = max(min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // least)), -(-n // most), 1)
    return rows.repartition(parts)


def _with_margins(rows: DataFrame, done: list[list[tuple]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            margins = np.array(_unpack(b, done)[1]).T.ravel()
            at = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(done))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(at, pa.array(margins)), b.column(2),
                                              b.column(3)], names=["y", "margins", "key", "bins"])

    return rows.mapInArrow(run, ROWS)


# ------------------------------------------------------------------ scoring
def booster_column(model: Booster) -> Column:
    """The model as one column expression over its features (a nested ``when``
    per tree), for batch and stream plans alike.

    Java compiles at most 64 KB of code a method. A model of more than
    ``COMPILED_NODES`` nodes is therefore wrapped in a lambda, which Spark
    evaluates without generating code; the sums and their order are the same.
    """
    names = {f for tree in model.trees for f, _, _ in tree.values() if f is not None}

    def total(value) -> str:
        def node(tree: dict, n: int) -> str:
            f, cut, weight = tree[n]
            if f is None:
                return _double(weight)
            return f"CASE WHEN {value(f)} > {_double(cut)} THEN {node(tree, 2 * n + 1)} ELSE {node(tree, 2 * n)} END"

        return " + ".join([_double(model.base), *[node(t, 1) for t in model.trees]])

    at = {f: f"_{i}" for i, f in enumerate(sorted(names))}
    if sum(map(len, model.trees)) <= COMPILED_NODES:
        return F.expr(total(lambda f: f"nanvl(CAST(`{f}` AS DOUBLE), CAST(NULL AS DOUBLE))"))
    fields = ", ".join(f"nanvl(CAST(`{f}` AS DOUBLE), CAST(NULL AS DOUBLE)) AS {at[f]}" for f in sorted(names))
    return F.expr(f"get(transform(array(struct({fields})), r -> {total(lambda f: f'r.{at[f]}')}), 0)")


def _double(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def predict_booster(df: DataFrame, model: Booster, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, booster_column(model))


def booster_table(spark: SparkSession, model: Booster) -> DataFrame:
    """``tree, node, feature, cut, weight``: a row per node (tree -1: the base)."""
    rows = [(-1, 0, None, None, float(model.base))]
    rows += [(t, n, f, c, w) for t, tree in enumerate(model.trees) for n, (f, c, w) in tree.items()]
    return spark.createDataFrame(rows, "tree int, node long, feature string, cut double, weight double")


def booster_of(table: DataFrame, features: list[str], params: dict | None = None) -> Booster:
    """The model of a stored table (its nodes are bounded by the parameters)."""
    model = Booster(list(features), 0.0, [], dict(params or {}))
    trees: dict[int, dict] = {}
    for r in table.collect():
        if r["tree"] < 0:
            model.base = r["weight"]
        else:
            trees.setdefault(r["tree"], {})[r["node"]] = (r["feature"], r["cut"], r["weight"])
    model.trees = [trees[t] for t in sorted(trees)]
    return model
