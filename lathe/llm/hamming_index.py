"""Approximate nearest neighbours by multi-index hashing of learned codes.

1. Codes: principal axes of a bounded sample, then ``ROTATIONS`` rotations
   learned by iterative quantization from different starts; the signs of the
   rotated components are the bits. Vectors are scaled to length 1 first, so
   that near codes mean a large cosine.
2. Radius: sampled queries are searched exactly inside the sample; the radius
   is the ``COVER`` quantile of the Hamming distances to their true
   neighbours. The neighbours in all data are nearer than those in a sample,
   so the radius errs toward more candidates.
3. Index: a code is cut into substrings of 8 bits. Two codes within radius
   r = m * s + a (m substrings) agree within s bits in one of the first a + 1
   substrings or within s - 1 bits in another one, so probing the buckets at
   those distances meets every code within the radius. A pair is taken at the
   first substring that meets it. Codes within the radius are ranked by the
   cosine of the original vectors, in double precision.

Layout: equal vectors are one entry with their smallest ids (k + 1 of them,
since a query may be one), so a vector that fills a third of the table is one
code. Entries are dealt by hash into blocks of about ``BLOCK``, each block
indexes its own entries, and every query visits every block in groups of
``QUERIES``; a task holds one block and one group. A block in which a query
finds fewer than k neighbours widens the radius for that query until k are
found or the block is exhausted. Only the best k + 1 ids per query and block
leave a task.

Defined results: null vectors, zero vectors, vectors with null or non-finite
components or of another length than most take no part; a null id takes no
part; repeated rows (same id and vector) count once; fewer candidates than k
give fewer rows; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import table
from lathe.llm.registry import register
from lathe.session import materialize

K = 5
EVERY = 50
SAMPLE = 8_000  # vectors to learn from
PROBES = 400  # sampled queries that set the radius
ROTATIONS = 4
COVER = 0.97
BLOCK = 16_384
QUERIES = 1_024
SUB = 8
PAIRS = 1 << 18  # pairs of codes compared at once
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 (scaled by the largest component first, so that no
    square overflows or vanishes)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def learn(x: np.ndarray, seed: int = 5, steps: int = 30) -> np.ndarray:
    """Projection (dimensions x bits) from unit vectors."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    _, axes = np.linalg.eigh(x.T @ x / len(x))
    out = []
    for _ in range(max(ROTATIONS, -(-16 // d))):
        r = np.linalg.qr(rng.standard_normal((d, d)))[0]
        v = x @ axes
        for _ in range(steps):
            u, _, w = np.linalg.svd(np.sign(v @ r).T @ v)
            r = (u @ w).T
        out.append(axes @ r)
    bits = np.concatenate(out, axis=1)
    return bits[:, :bits.shape[1] // SUB * SUB]


def codes(x: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Packed codes, a byte per substring."""
    return np.packbits(x @ projection > 0, axis=1)


def words(codes: np.ndarray) -> np.ndarray:
    """The codes as rows of 64-bit words, a column per code."""
    wide = np.zeros((len(codes), -(-codes.shape[1] // 8) * 8), np.uint8)
    wide[:, :codes.shape[1]] = codes
    return np.ascontiguousarray(wide.view(np.uint64).T)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances between the columns of two arrays of words."""
    out = np.zeros((a.shape[1], b.shape[1]), np.uint16)
    for x, y in zip(a, b, strict=True):
        out += np.bitwise_count(x[:, None] ^ y[None, :])
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of each code of ``a`` to each of ``b``."""
    return _apart(words(a), words(b)).astype(np.int32)


def radius(x: np.ndarray, projection: np.ndarray, k: int) -> int:
    """COVER quantile of the distance to true neighbours inside the sample."""
    q = x[:PROBES]
    sims = q @ x.T
    sims[np.arange(len(q)), np.arange(len(q))] = -2
    k = min(k, len(x) - 1)
    if k < 1:
        return projection.shape[1]
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    h = distances(codes(q, projection), codes(x, projection))
    return int(np.quantile(np.take_along_axis(h, near, axis=1), COVER))


def probe_radii(r: int, m: int) -> list[int]:
    """Substring radii that meet every code within ``r`` (-1: not probed)."""
    s, a = divmod(min(r, m * SUB), m)
    return [s if j <= a else s - 1 for j in range(m)]


def within(q: np.ndarray, c: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, code) within Hamming radius ``r``, found through the
    substring buckets, each pair once."""
    m = q.shape[1]
    radii = np.array(probe_radii(r, m))
    values = np.arange(256, dtype=np.uint8)
    q_words, c_words = words(q), words(c)
    out_q, out_c = [], []
    for j in range(m):
        if radii[j] < 0:
            continue
        order = np.argsort(c[:, j], kind="stable")
        edge = np.searchsorted(c[order, j], np.arange(257))
        by_bucket = c_words[:, order]
        for v in np.flatnonzero(np.diff(edge)):
            probing = np.flatnonzero(_POP[q[:, j] ^ values[v]] <= radii[j])
            if not len(probing):
                continue
            bucket = order[edge[v]:edge[v + 1]]
            step = max(1, PAIRS // len(bucket))
            for some in (probing[i:i + step] for i in range(0, len(probing), step)):
                a, b = np.nonzero(_apart(q_words[:, some], by_bucket[:, edge[v]:edge[v + 1]]) <= r)
                a, b = some[a], bucket[b]
                if j:  # met at an earlier substring
                    new = ~(_POP[q[a, :j] ^ c[b, :j]] <= radii[:j]).any(axis=1)
                    a, b = a[new], b[new]
                out_q.append(a)
                out_c.append(b)
    if not out_q:
        return np.zeros(0, np.intp), np.zeros(0, np.intp)
    return np.concatenate(out_q), np.concatenate(out_c)


def _search(group: pd.DataFrame, projection: np.ndarray, r: int, k: int) -> pd.DataFrame:
    """Best k + 1 ids of one block for each query of one group."""
    is_q = group["_query"].to_numpy()
    qs, cs = group[is_q], group[~is_q]
    out = []
    if len(qs) and len(cs):
        x, y = (np.array(g["_v"].tolist(), np.float64) for g in (qs, cs))
        ux, uy = unit(x), unit(y)
        cq, cc = codes(ux, projection), codes(uy, projection)
        ids = cs["_ids"].tolist()
        own = qs["_key"].to_numpy()
        at, to = within(cq, cc, r)
        order = np.argsort(at, kind="stable")
        at, to = at[order], to[order]
        bounds = np.searchsorted(at, np.arange(len(qs) + 1))
        n_ids = np.array([len(i) for i in ids])
        for i in range(len(qs)):
            got = to[bounds[i]:bounds[i + 1]]
            if n_ids[got].sum() < k + 1:  # too few: widen to the k + 1 nearest codes, with all ties
                h = distances(cq[i:i + 1], cc)[0]
                got = np.flatnonzero(h <= np.partition(h, min(k, len(h) - 1))[min(k, len(h) - 1)])
            dots = (uy[got] * ux[i]).sum(axis=1)
            best = sorted((-s, v) for s, g in zip(dots.tolist(), got, strict=True) for v in ids[g])[:k + 1] \
                if len(got) <= 4 * k else _best(dots, got, ids, k)
            out += [(own[i], v, -s) for s, v in best]
    return pd.DataFrame(out, columns=["_key", "vec_id", "score"])


def _best(dots: np.ndarray, got: np.ndarray, ids: list, k: int) -> list[tuple[float, int]]:
    cut = np.partition(dots, len(dots) - k - 1)[len(dots) - k - 1]
    keep = dots >= cut
    return sorted((-s, v) for s, g in zip(dots[keep].tolist(), got[keep], strict=True) for v in ids[g])[:k + 1]


def entries(df: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """Distinct vectors that take part: ``_v, _key`` (smallest id), ``_ids``
    (its k + 1 smallest ids)."""
    v = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("_id"), v.alias("_v")).where(
        F.col("_id").isNotNull() & F.col("_v").isNotNull())
    good = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        "_v", lambda x: x != 0)
    rows = rows.where(good).withColumn("_v", F.transform("_v", lambda x: x + F.lit(0.0))).distinct()
    size = rows.groupBy(F.size("_v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return rows.select("_v", F.col("_id").alias("_key"), F.array("_id").alias("_ids"))
    turn = Window.partitionBy("_v").orderBy("_id")  # rank filter: few rows per vector leave a task
    few = rows.where(F.size("_v") == size["n"]).withColumn("_turn", F.row_number().over(turn)).where(
        F.col("_turn") <= k + 1)
    return few.groupBy("_v").agg(F.min("_id").alias("_key"), F.array_sort(F.collect_list("_id")).alias("_ids"))


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
            every: int = EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by
    ``every``, against all rows."""
    spark = df.sparkSession
    found = materialize(entries(df, id_col, vector_col, k), "vectors")
    asked = materialize(df.where(F.col(id_col) % every == 0).select(
        F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("_qv")).distinct()
        .join(found.select("_v", "_key"), F.transform("_qv", lambda x: x + F.lit(0.0)) == F.col("_v")).select(
            "query_id", "_key"), "queries")
    sample = found.orderBy(F.xxhash64("_key")).limit(SAMPLE).select("_v").toPandas()  # bounded sample
    if sample.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = unit(np.array(sample["_v"].tolist(), np.float64))
    projection = learn(x)
    r = radius(x, projection, k)
    n, n_q = found.count(), asked.select("_key").distinct().count()
    blocks, groups = -(-n // BLOCK), max(1, -(-n_q // QUERIES))
    here = lambda seed, size: F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(size)).cast("int")
    q = found.join(asked.select("_key").distinct(), "_key").withColumn("_group", here(1, groups)).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("_query", F.lit(True))
    c = found.withColumn("_block", here(2, blocks)).withColumn(
        "_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("_query", F.lit(False))
    cols = ["_group", "_block", "_query", "_key", "_v", "_ids"]
    shared = spark.sparkContext.broadcast(projection)
    best = q.select(*cols).unionByName(c.select(*cols)).groupBy("_block", "_group").applyInPandas(
        lambda g: _search(g, shared.value, r, k), "_key long, vec_id long, score double")
    order = [F.desc("score"), F.col("vec_id")]
    top = Window.partitionBy("_key").orderBy(*order)
    best = best.withColumn("_n", F.row_number().over(top)).where(F.col("_n") <= k + 1).drop("_n")
    got = asked.join(best, "_key").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return got.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


@register("op3_hamming_index")
def op3_hamming_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
