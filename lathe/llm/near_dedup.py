"""MinHash near-dedup with SuperMinHash signatures, banding, exact
verification and components.

1. ``sketches``: word hashes (JVM) become distinct 64-bit shingle hashes, a
   128-bit digest of the whole set, and a SuperMinHash signature: each shingle
   walks a permutation of the ``M`` slots and proposes the value j + r_j for
   the j-th slot of its walk; the values of a shingle are correlated (one in
   each unit interval), which lowers the variance against plain MinHash. A
   document stops at level j once none of its slots exceeds j.
2. Documents with equal sets are one class, whatever their number; all later
   steps see classes.
3. ``BANDS`` bands of ``ROWS`` slots make the buckets. A pair at similarity
   0.75 shares no bucket with probability (1 - 0.75^4)^32 = 5e-6.
4. Hub round: in each bucket the smallest digest is compared with the others.
   Signature bytes discard pairs estimated below ``ESTIMATE`` (4.5 standard
   deviations under 0.75); each member is verified on full shingle sets
   against the smallest hub that is left, one row per member.
5. Rest round: buckets that still hold several components (of buckets with
   equal members one) are cut into blocks of about ``BLOCK`` shingles. Members
   outside a bucket's largest component meet all its members, block against
   block inside the tasks, with their shingle sets: a sharper estimate
   (``WIDE`` slots, ``SHARP``, again 4.5 deviations) screens a pair, its sets
   verify it, and the task joins the two components, whose other pairs are
   compared no more. Only links that join components leave a task, fewer than
   it has rows, so no bucket, whatever its size, is capped, and neither near
   copies nor documents that share half of their text make rows by pairs.

Components are alternating large-star and small-star rounds over written
tables; nothing is collected but counts.

Defined results: a null, empty or wordless text has an empty set, links with
nothing and is its own component; fewer words than ``K`` make one shingle of
all; repeated rows are linked copies; a null id never names a component (its
row gets the smallest id of its group, or null) and is not kept; an empty
table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import ascii_lower, row_key, table, text_or_empty
from lathe.llm.registry import register
from lathe.session import materialize

K = 5
M = 128
ROWS = 4
BANDS = M // ROWS
PERCENT = 75
ESTIMATE = 0.58
WIDE = 512
SHARP = 0.66
BLOCK = 400_000  # shingles of a block; a member counts as at least MEMBER
MEMBER = 256
CHUNK = 40_000  # shingles sketched together: their walks take CHUNK * M bytes

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the ``K``-word shingles of one document."""
    n = len(words)
    if n == 0:
        return words
    with np.errstate(over="ignore"):
        if n < K:
            h = np.full(1, n, _U)
            for w in words:
                h = mix(h * _U(0x9E3779B97F4A7C15) + w)
            return h
        h = words[:n - K + 1]
        for j in range(1, K):
            h = mix(h) * _U(0x9E3779B97F4A7C15) + words[j:n - K + 1 + j]
        return np.unique(mix(h))


def superminhash(elements: np.ndarray, doc: np.ndarray, n_docs: int, m: int = M) -> np.ndarray:
    """Signatures of ``n_docs`` sets; ``doc`` gives each element's set. Slot
    values are level << 32 | 32 random bits."""
    sig = np.full((n_docs, m), np.iinfo(np.uint64).max, _U)
    flat = sig.reshape(-1)
    walk, level = None, 0
    while len(elements) and level < m:
        with np.errstate(over="ignore"):
            x = mix(elements + _U((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        value = (x >> _U(32)) | _U(level << 32)
        to = (((x & _U(0xFFFFFFFF)) * _U(m - level)) >> _U(32)).astype(np.intp) + level
        if walk is None:
            slot = to
        else:
            rows = np.arange(len(elements))
            slot = walk[rows, to].astype(np.intp)
            walk[rows, to] = walk[:, level]
        np.minimum.at(flat, doc * m + slot, value)
        level += 1
        open_doc = sig.max(axis=1) >= _U(level << 32)
        go = open_doc[doc]
        if walk is None:
            first, elements, doc = to[go], elements[go], doc[go]
            walk = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(elements), 1))
            walk[np.arange(len(elements)), first] = 0
        elif not go.all():
            elements, doc, walk = elements[go], doc[go], walk[go]
    return sig


def band_hashes(sig: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        parts = sig.reshape(len(sig), BANDS, ROWS)
        h = np.broadcast_to(np.arange(BANDS, dtype=_U), parts.shape[:2])
        for j in range(ROWS):
            h = mix(h * _U(0x9E3779B97F4A7C15) + parts[:, :, j])
    return h


def word_hashes(text: Column) -> Column:
    words = F.regexp_extract_all(ascii_lower(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).view(_U)
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield shingles(flat[a:b])


def _runs(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """Shingle sets in runs of about CHUNK shingles."""
    run, n = [], 0
    for s in _sets(column):
        run.append(s)
        n += len(s)
        if n >= CHUNK:
            yield run
            run, n = [], 0
    if run:
        yield run


def _signatures(run: list[np.ndarray], m: int = M) -> np.ndarray:
    """Signatures of a run; a document of many chunks is folded chunk by chunk
    (the minimum over parts of a set is the set's signature)."""
    if len(run) == 1 and len(run[0]) > 2 * CHUNK:
        parts = [superminhash(run[0][i:i + CHUNK], np.zeros(len(run[0][i:i + CHUNK]), np.intp), 1, m)
                 for i in range(0, len(run[0]), CHUNK)]
        return np.minimum.reduce(parts)
    return superminhash(np.concatenate(run), np.repeat(np.arange(len(run)), [len(s) for s in run]), len(run), m)


def _as_bytes(sig: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in (sig & _U(0xFF)).astype(np.uint8)], pa.binary())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for run in _runs(batch.column(1)):
            sig = _signatures(run)
            bands = band_hashes(sig).view(np.int64)
            empty = np.array([len(s) == 0 for s in run])
            offsets = np.arange(0, BANDS * len(run) + 1, BANDS, dtype=np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(bands.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(run)), pa.array([len(s) for s in run], pa.int64()),
                 pa.array([None if e else hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                           for s, e in zip(run, empty, strict=True)], pa.binary()),
                 lists, _as_bytes(sig)],
                names=["_id", "n", "digest", "bands", "sig"])
            at += len(run)


def sketches(docs: DataFrame) -> DataFrame:
    """``_id, n, digest, bands, sig`` of ``_id, _text`` rows; an empty set has
    no digest."""
    kind = docs.schema["_id"].dataType.simpleString()
    return docs.select("_id", word_hashes(F.col("_text")).alias("_h")).mapInArrow(
        _sketch, f"_id {kind}, n long, digest binary, bands array<long>, sig binary")


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for run in _runs(batch.column(1)):
            offsets = np.cumsum([0, *map(len, run)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(run).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(run)), lists, _as_bytes(_signatures(run, WIDE))],
                                             names=["digest", "members", "wide"])
            at += len(run)


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity from signature bytes (chance agreement removed)."""
    return (a == b).mean(axis=-1) * (256 / 255) - 1 / 255


def _near_hub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, M) for i in (2, 3))
            ok = pa.array(_alike(a, b) >= ESTIMATE)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(ok)


def _spanning(rows: pa.RecordBatch) -> Iterator[tuple[bytes, bytes]]:
    """Verified links that join components, from the rows of one pair of
    blocks: rows of the left block against those of the right one."""
    left, right = (np.flatnonzero(rows.column(c).to_numpy(zero_copy_only=False)) for c in ("_left", "_right"))
    if not len(left) or not len(right):
        return
    n, minor = rows.column("n").to_numpy(), rows.column("_minor").to_numpy(zero_copy_only=False)
    digest = rows.column("digest").to_pylist()
    order = np.empty(len(digest), np.int64)
    order[sorted(range(len(digest)), key=digest.__getitem__)] = np.arange(len(digest))
    label = np.unique(np.array([c.hex() for c in rows.column("comp").to_pylist()]), return_inverse=True)[1]
    if label.max() == 0:
        return
    wide = np.frombuffer(b"".join(rows.column("wide").to_pylist()), np.uint8).reshape(-1, WIDE)
    at = rows.column("members").offsets.to_numpy()
    flat = rows.column("members").values.to_numpy()
    for x in left:
        # of two rows outside the largest component, each left in some group, one order is enough
        ok = (label[right] != label[x]) & ~(minor[right] & (order[right] < order[x]))
        ok &= 100 * np.minimum(n[right], n[x]) >= PERCENT * np.maximum(n[right], n[x])
        near = right[ok]
        alike = _alike(wide[near], wide[x])
        near, alike = near[alike >= SHARP], alike[alike >= SHARP]
        near = near[np.argsort(-alike, kind="stable")]
        while len(near):
            y, near = near[0], near[1:]
            shared = len(np.intersect1d(flat[at[x]:at[x + 1]], flat[at[y]:at[y + 1]], assume_unique=True))
            if 100 * shared >= PERCENT * (n[x] + n[y] - shared):
                yield max(digest[x], digest[y]), min(digest[x], digest[y])
                label[label == label[y]] = label[x]
                near = near[label[near] != label[x]]


def _near_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_spanning`` of every group of rows sorted by group; a group is at most
    two blocks. Groups cut by the end of a batch are carried to the next."""
    kept: pa.Table | None = None

    def links(table: pa.Table) -> pa.RecordBatch:
        rows = table.combine_chunks().to_batches()[0]
        group = np.column_stack([rows.column(c).to_numpy() for c in ("bucket", "_i", "_j")])
        cut = np.flatnonzero((np.diff(group, axis=0) != 0).any(axis=1)) + 1
        edges = [0, *cut.tolist(), len(group)]
        found = [uv for a, b in zip(edges[:-1], edges[1:], strict=True) if b - a > 1
                 for uv in _spanning(rows.slice(a, b - a))]
        return pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.binary()),
                                           pa.array([v for _, v in found], pa.binary())], names=["u", "v"])

    for batch in batches:
        rows = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
        if not rows.num_rows:
            continue
        group = np.column_stack([rows.column(c).to_numpy() for c in ("bucket", "_i", "_j")])
        last = int(np.argmax((group == group[-1]).all(axis=1)))
        if last:
            yield links(rows.slice(0, last))
        kept = rows.slice(last)
    if kept is not None and kept.num_rows > 1:
        yield links(kept)


def _fits(a: str, b: str) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def words_of(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``digest, _h`` (word hashes) of one document of each wanted class."""
    rows = classes.join(wanted, "digest").select("digest", "row")
    texts = docs.withColumn("_row", row_key("_id", "_text")).join(
        rows, F.col("_row") == F.col("row"), "inner").dropDuplicates(["digest"])
    return texts.select("digest", word_hashes(F.col("_text")).alias("_h"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``u, v`` whose full shingle sets reach the similarity."""
    left = pairs.join(sets.select(F.col("digest").alias("u"), F.col("members").alias("a")), "u")
    both = left.join(sets.select(F.col("digest").alias("v"), F.col("members").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    return both.where(100 * shared >= PERCENT * (F.size("a") + F.size("b") - shared)).select("u", "v")


def components(links: DataFrame) -> DataFrame:
    """``u, v``: each linked node and the smallest node of its component."""
    def state(e):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .where("u != v").distinct(), "links")
    now = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, now = now, state(edges)
        if now == before:
            return edges


def between_components(met: DataFrame, comp: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """``u, v``: verified links between classes of different components that
    share a bucket, enough to span what the components make together."""
    rest = (met.select("bucket", "digest").join(classes.select("digest", "n"), "digest")
            .join(comp.withColumnRenamed("u", "digest"), "digest", "left")
            .select("bucket", "digest", "n", F.coalesce("v", "digest").alias("comp")))
    rest = materialize(rest, "rest")
    weight = F.greatest(F.col("n"), F.lit(MEMBER))
    parts = rest.groupBy("bucket", "comp").agg(
        F.sum(weight).alias("_w"), F.bit_xor(F.xxhash64("digest")).alias("_x"),
        F.bit_xor(F.xxhash64(F.lit(1), "digest")).alias("_y"), F.count(F.lit(1)).alias("_n"))
    blocks = lambda w: F.ceil(w / BLOCK).cast("int")
    mixed = parts.groupBy("bucket").agg(
        F.max_by("comp", F.struct("_w", "comp")).alias("_major"), F.count(F.lit(1)).alias("_parts"),
        blocks(F.sum("_w")).alias("_all"), blocks(F.sum("_w") - F.max("_w")).alias("_few"), F.bit_xor("_x").alias("_x"),
        F.bit_xor("_y").alias("_y"), F.sum("_n").alias("_n")).where("_parts > 1")
    # buckets with the same members are one; the hashes of their sets have 128 bits
    mixed = mixed.groupBy("_x", "_y", "_n").agg(F.min_by(F.struct("bucket", "_major", "_all", "_few"), "bucket").alias("_b"))
    rest = rest.join(mixed.select("_b.*"), "bucket").withColumn("_minor", F.col("comp") != F.col("_major"))
    rest = rest.withColumn("_at", F.pmod(F.xxhash64("digest"), F.col("_all")).cast("int"))
    rest = rest.withColumn("_own", F.when(F.col("_minor"), F.pmod(F.xxhash64(F.lit(1), "digest"), F.col("_few")).cast("int")))
    as_right = F.transform(F.sequence(F.lit(0), F.col("_few") - 1), lambda i: F.struct(i.alias("_i"), F.col("_at").alias("_j")))
    as_left = F.transform(F.sequence(F.lit(0), F.col("_all") - 1), lambda j: F.struct(F.col("_own").alias("_i"), j.alias("_j")))
    group = ["bucket", "_i", "_j"]
    rest = rest.join(sets, "digest").withColumn(
        "_g", F.explode(F.when(F.col("_minor"), F.array_union(as_right, as_left)).otherwise(as_right)))
    rest = rest.select("bucket", "_g._i", "_g._j", (F.col("_minor") & (F.col("_own") == F.col("_g._i"))).alias("_left"),
                       (F.col("_at") == F.col("_g._j")).alias("_right"), "_minor", "digest", "comp", "n", "wide", "members")
    rest = rest.withColumn("_left", F.coalesce("_left", F.lit(False)))
    return (rest.repartition(*group).sortWithinPartitions(*group)
            .mapInArrow(_near_in_blocks, "u binary, v binary").distinct())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row`` (hash of id and text), ``_id, n, comp`` (the smallest digest of
    the component, null without words), ``comp_id`` (its smallest id) per row
    of ``df``; components that share an id share ``comp_id``, not ``comp``."""
    docs = df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    sketched = materialize(sketches(docs.withColumn("_id", F.struct("_id", row_key("_id", "_text").alias("row"))))
                           .select("_id._id", "_id.row", "n", "digest", "bands", "sig"), "sketches")
    classes = materialize(sketched.where("digest is not null").groupBy("digest").agg(
        F.min("_id").alias("least"), F.min("row").alias("row"), F.min("n").alias("n"),
        F.first("bands").alias("bands"), F.first("sig").alias("sig")), "classes")
    banded = classes.select("digest", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("digest").alias("hub"), F.max("digest").alias("_max")).where(
        "hub != _max").drop("_max")
    met = materialize(banded.join(shared, "bucket"), "buckets")
    sets = materialize(words_of(met.select("digest").distinct(), classes, docs).mapInArrow(
        _expand, "digest binary, members array<long>, wide binary"), "sets")
    info = classes.select("digest", "n", "sig")
    hubs = info.select(*[F.col(c).alias(f"hub_{c}") for c in info.columns])
    pairs = (met.where("digest != hub").select("digest", "hub").distinct().join(info, "digest")
             .join(hubs, F.col("hub") == F.col("hub_digest")).where(_fits("n", "hub_n")))
    pairs = pairs.select("digest", "hub", "sig", "hub_sig").mapInArrow(_near_hub, "u binary, v binary")
    pairs = materialize(pairs.groupBy("u").agg(F.min("v").alias("v")), "pairs")
    comp = components(verified(pairs, sets))
    root = lambda c: comp.select(F.col("u").alias(c), F.col("v").alias(f"{c}_root"))
    more = materialize(between_components(met, comp, classes, sets), "links")
    between = (more.join(root("u"), "u", "left").join(root("v"), "v", "left")
               .select(F.coalesce("u_root", "u").alias("u"), F.coalesce("v_root", "v").alias("v")))
    merged = components(between)  # links between the components so far
    named = (classes.select("digest", "least").join(root("digest"), "digest", "left")
             .withColumn("comp", F.coalesce("digest_root", "digest"))
             .join(merged.select(F.col("u").alias("comp"), F.col("v").alias("final")), "comp", "left")
             .select("digest", "least", F.coalesce("final", "comp").alias("comp")))
    named = named.join(named.groupBy("comp").agg(F.min("least").alias("comp_id")), "comp").select("digest", "comp", "comp_id")
    return sketched.select("_id", "row", "n", "digest").join(named, "digest", "left").select(
        F.col("row").alias("_row"), "_id", "n", "comp",
        F.when(F.col("digest").isNull(), F.col("_id")).otherwise(F.col("comp_id")).alias("comp_id"))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, kept`` per row."""
    got = near_duplicates(df, id_col, text_col)
    return got.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("comp_id").alias("component_id"),
                      F.coalesce(F.col("_id") == F.col("comp_id"), F.lit(False)).alias("kept"))


def without_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay: of each group the one with the smallest
    id (of repeated rows the one whose other columns come first as JSON;
    groups without an id keep the row with the smallest hash). Rows without
    words all stay."""
    got = near_duplicates(df, id_col, text_col)
    group = Window.partitionBy("comp").orderBy(F.col("_id").asc_nulls_last(), "_row")
    first = got.where("n > 0").withColumn("_turn", F.row_number().over(group)).where("_turn = 1").select(
        "_row", F.lit(True).alias("_one"))
    loose = got.where("n = 0").select("_row", F.lit(False).alias("_one")).distinct()
    keep = first.unionByName(loose).withColumnRenamed("_row", "_dedup_key")
    keyed = df.withColumn("_dedup_row", row_key(id_col, text_or_empty(text_col)))
    kept = keyed.join(keep, F.col("_dedup_row") == F.col("_dedup_key")).drop("_dedup_key")
    others = [c for c in df.columns if c not in (id_col, text_col)]
    copies = Window.partitionBy("_dedup_row").orderBy(F.to_json(F.struct(*others)) if others else F.lit(0))
    once = kept.where("_one").withColumn("_dedup_n", F.row_number().over(copies)).where("_dedup_n = 1")
    return once.drop("_dedup_n").unionByName(kept.where("not _one")).drop("_dedup_row", "_one")


@register("op9_near_dedup")
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))
