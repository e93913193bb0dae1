"""Boosted trees in DuckDB SQL for the oracles: the fit itself, split by split
in a recursive query, written apart from ``lathe.operators.boost``."""

from __future__ import annotations

from lathe.operators.boost import BoostParams, tree_columns

SCALE = 65536  # fixed-point steps of a gradient, as in the operator on tables of this size


def booster_sql(src: str, key: list[str], target: str, features: list[str], p: BoostParams,
                name: str = "boosted", keep: str = "train", only: str = "true") -> str:
    """CTEs ending in ``name`` (``key`` columns, ``prediction``): fitted on the
    rows of ``src`` where ``keep``, applied to all; ``only`` filters the
    result (``s.fitted``: the row was fitted). Needs ``WITH RECURSIVE``."""
    n = name
    g = lambda x: f"({x}::DOUBLE / {SCALE}::DOUBLE)"
    soft = lambda x: (f"(CASE WHEN {g(x)} > {p.reg_alpha}::DOUBLE THEN {g(x)} - {p.reg_alpha}::DOUBLE "  # noqa: E731
                      f"WHEN {g(x)} < -({p.reg_alpha}::DOUBLE) THEN {g(x)} + {p.reg_alpha}::DOUBLE ELSE 0::DOUBLE END)")
    score = lambda x, k: f"({soft(x)} * {soft(x)} / ({k}::DOUBLE + {p.reg_lambda}::DOUBLE))"
    steps = ", ".join(str(k / p.max_bins) for k in range(1, p.max_bins))
    cuts = [f"SELECT {i} AS f, CASE WHEN count(DISTINCT x) <= {p.max_bins} THEN list_sort(list(DISTINCT x))[:-2] "
            f"ELSE list_sort(list_distinct(quantile_cont(x, [{steps}]))) END AS cuts FROM (SELECT {f}::DOUBLE AS x FROM {src} "
            f"WHERE {keep} AND {f} IS NOT NULL AND NOT isnan({f}::DOUBLE))" for i, f in enumerate(features)]
    bins = ", ".join(f"CASE WHEN {f} IS NULL OR isnan({f}::DOUBLE) THEN 0 ELSE len(list_filter((SELECT cuts FROM {n}_cuts "
                     f"WHERE f = {i}), lambda c: c < {f}::DOUBLE)) END" for i, f in enumerate(features))
    drawn = ", ".join(f"({t}, {f})" for t in range(p.n_estimators) for f in tree_columns(p, len(features), t))
    by_leaf = p.num_leaves is not None
    where = f"step < {p.num_leaves - 1}" if by_leaf else "node >= (1 << step)"
    choice = "ORDER BY gain DESC, node, f, bin" if by_leaf else "PARTITION BY node ORDER BY gain DESC, f, bin"
    keys = ", ".join(f"s.{c}" for c in key)
    own = ", ".join(key)
    return f"""
{n}_cuts AS MATERIALIZED ({' UNION ALL '.join(cuts)}),
{n}_base AS MATERIALIZED (SELECT sum(floor({target}::DOUBLE * {SCALE}::DOUBLE + 0.5::DOUBLE)::BIGINT)::DOUBLE / count(*)::DOUBLE
                     / {SCALE}::DOUBLE AS base FROM {src} WHERE {keep}),
{n}_drawn(tree, f) AS MATERIALIZED (VALUES {drawn}),
{n}_st AS (
  SELECT {own}, {keep} AS fitted, {target}::DOUBLE AS y, [{bins}] AS bins, (SELECT base FROM {n}_base) AS margin,
         1::BIGINT AS node, 0 AS tree, 0 AS step FROM {src}
  UNION ALL
  SELECT * FROM (
    WITH w AS (SELECT * FROM {n}_st WHERE tree < {p.n_estimators}),
    h AS (SELECT w.step, w.node, d.f, w.bins[d.f + 1] AS bin,
                 sum(floor((margin - y) * {SCALE}::DOUBLE + 0.5::DOUBLE)::BIGINT) AS g, count(*) AS n
          FROM w JOIN {n}_drawn d ON d.tree = w.tree WHERE fitted AND node < {1 << p.depth()} AND {where} GROUP BY ALL),
    c AS (SELECT *, sum(g) OVER o AS gl, sum(n) OVER o AS nl, sum(g) OVER a AS gt, sum(n) OVER a AS nt FROM h
          WINDOW o AS (PARTITION BY node, f ORDER BY bin), a AS (PARTITION BY node, f)),
    k AS (SELECT *, {score('gl', 'nl')} + {score('(gt - gl)', '(nt - nl)')} - {score('gt', 'nt')} AS gain FROM c
          WHERE nl >= {p.min_child_rows} AND nt - nl >= {p.min_child_rows} AND nl < nt),
    b AS (SELECT node, f, bin FROM k WHERE gain > 0 QUALIFY row_number() OVER ({choice}) = 1),
    e AS (SELECT count(*) = 0 AS ends FROM b),
    l AS (SELECT node, -({soft('g')}) / (n::DOUBLE + {p.reg_lambda}::DOUBLE) * {p.learning_rate}::DOUBLE AS weight FROM (
            SELECT node, sum(floor((margin - y) * {SCALE}::DOUBLE + 0.5::DOUBLE)::BIGINT) AS g, count(*) AS n
            FROM w WHERE fitted GROUP BY node))
    SELECT {', '.join(f'w.{c}' for c in key)}, w.fitted, w.y, w.bins,
           CASE WHEN e.ends THEN w.margin + l.weight ELSE w.margin END AS margin,
           CASE WHEN e.ends THEN 1 WHEN b.f IS NULL THEN w.node
                WHEN w.bins[b.f + 1] > b.bin THEN 2 * w.node + 1 ELSE 2 * w.node END AS node,
           CASE WHEN e.ends THEN w.tree + 1 ELSE w.tree END AS tree,
           CASE WHEN e.ends THEN 0 ELSE w.step + 1 END AS step
    FROM w CROSS JOIN e JOIN l ON l.node = w.node LEFT JOIN b ON b.node = w.node)),
{n} AS (SELECT {keys}, s.margin AS prediction FROM {n}_st s WHERE s.tree = {p.n_estimators} AND {only})"""
