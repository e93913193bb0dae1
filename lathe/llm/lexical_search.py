"""Ranked lexical search by bag deduplication.

Documents are ranked for each item of a stated query set by a sum, over the
item's terms, of the term's weight times a saturating count that falls with
the document's length class m (see ``op12_lexical_search``).

1. One pass over the documents counts all terms of each (its length) and keeps
   the counts of the terms that occur in some item: the restricted bag.
2. Lengths give N, L and each document's m; bags give the document frequencies.
3. Documents with equal bag and equal m have equal scores for every item. They
   are put together by a 64-bit hash of (bag, m) and then by bag and m
   themselves, so a hash collision joins nothing. A class keeps its ``TOP``
   smallest ids: no other member can be among an item's ``TOP``.
4. Each class is scored once, against all items, by adding rows of the (term,
   item) weight table; a task keeps the ``TOP`` best classes of each item by
   (score, smallest id).
5. The kept classes are expanded into their members by ascending id and ranked.

The query set is taken in blocks of bounded size (``BLOCK_ITEMS``,
``BLOCK_TERMS``): a block's vocabulary and weights are what the driver and a
broadcast hold. Each block reads the documents once.

Scale: texts are read where they lie; what is shuffled is one restricted bag
per document, after classes were cut to ``TOP`` rows within each task, so a
text that a third of all rows repeat is ``TOP`` rows a task.

Defined results: a document that is null, empty or without terms counts for
nothing and is not ranked; an item without terms, or without a document above
0, has no rows; rows sharing an ``item_id`` (or having none) are one item with
the terms of all; repeated rows are documents of their own, ranked one after
the other; a null id comes after all ids of its score; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import table
from lathe.llm.registry import register
from lathe.session import materialize

TOP = 10
BLOCK_ITEMS = 256
BLOCK_TERMS = 20_000  # (item, term) pairs of a block; one larger item is a block alone
SLICE = 4_000  # bag entries scored at a time in a task

# Bytes of a term: digits, letters (A-Z lower-cased) and all of non-ASCII characters.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Blocks (ids, distinct terms of each) of the query set, in id order."""
    id_type = items.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            got = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            at = np.repeat(np.arange(len(got)), [len(g) for g in got])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(
                [t for g in got for t in g], pa.binary())], names=["_item", "_term"])

    pairs = items.select(F.col(id_col).alias("_item"), F.col(text_col).cast("string").alias("_text")).mapInArrow(
        run, f"_item {id_type}, _term binary").distinct().orderBy(F.col("_item").asc_nulls_last(), "_term")
    ids: list = []
    terms: list[list[bytes]] = []
    held = 0
    for item, term in materialize(pairs, "items").orderBy(F.col("_item").asc_nulls_last(), "_term").toLocalIterator():
        if not ids or ids[-1] != item:
            if ids and (len(ids) == BLOCK_ITEMS or held >= BLOCK_TERMS):
                yield ids, terms
                ids, terms, held = [], [], 0
            ids.append(item)
            terms.append([])
        terms[-1].append(bytes(term))
        held += 1
    if ids:
        yield ids, terms


def bags(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``_id, n, t, f`` of each document with terms: its length in terms, and
    the sorted numbers and counts of those in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        get = shared.value.get
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, n, t, f, ends = [], [], [], [], [0]
                for row, text in enumerate(part.column(1).to_pylist()):
                    words = terms_of(text)
                    if not words:
                        continue
                    found = Counter(map(get, words))
                    found.pop(None, None)
                    rows.append(row)
                    n.append(len(words))
                    for k in sorted(found):
                        t.append(k)
                        f.append(found[k])
                    ends.append(len(t))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(t, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(f, pa.int64()))], names=["_id", "n", "t", "f"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(
        run, f"_id {id_type}, n long, t array<int>, f array<long>")


def classes(bag: DataFrame, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """``m, t, f, ids``: a row per class of documents with equal bag and m,
    with its ``top`` smallest ids in order (repeats kept, null last)."""
    m = F.expr(f"10L + ((90L * n * {n_docs}L) div {n_terms}L)")
    keyed = bag.where(F.size("t") > 0).withColumn("m", m).withColumn("_h", F.xxhash64("t", "f", "m"))
    key = ["_h", "m", "t", "f"]
    first = Window.partitionBy(*key).orderBy(F.col("_id").asc_nulls_last())
    least = keyed.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= top)
    held = F.array_sort(F.collect_list(F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"))))
    return least.groupBy(*key).agg(held.alias("ids")).select("m", "t", "f", F.col("ids.id").alias("ids"))


def best_classes(cls: DataFrame, ids: list, weights: np.ndarray, item_type: str, top: int = TOP) -> DataFrame:
    """``_item, score, ids``: of each task, the ``top`` best classes of each
    item by (score, smallest id). ``weights`` is the (term, item) table."""
    shared = cls.sparkSession.sparkContext.broadcast((ids, weights))
    doc_type = cls.schema["ids"].dataType.simpleString()

    def run(batches):
        items, table_ = shared.value
        best: list[list] = [[] for _ in items]
        least = np.ones(len(items), np.int64)  # below it, a score cannot enter
        seq = 0
        schema = None
        for batch in batches:
            schema = batch.schema
            m = batch.column(0).to_numpy()
            t, f = batch.column(1), batch.column(2)
            ends = t.offsets.to_numpy().astype(np.int64)
            flat_t, flat_f = t.values.to_numpy(), f.values.to_numpy()
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + SLICE, "right")) - 1)
                a, b = ends[lo], ends[hi]
                tf = flat_f[a:b]
                part = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m[lo:hi], np.diff(ends[lo:hi + 1])))
                score = np.add.reduceat(table_[flat_t[a:b]] * part[:, None], ends[lo:hi] - a, axis=0)
                for row, item in zip(*np.nonzero(score >= least)):
                    mine = best[item]
                    members = batch.column(3)[lo + int(row)].as_py()
                    seq += 1
                    mine.append((-int(score[row, item]), members[0] is None, 0 if members[0] is None else members[0],
                                 seq, members))
                    if len(mine) >= 4 * top:
                        mine.sort()
                        del mine[top:]
                        least[item] = -mine[-1][0]
                lo = hi
        if schema is None:
            return
        rows = [(i, -x[0], x[4]) for i, mine in zip(items, best) for x in sorted(mine)[:top]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], shared_type), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], schema.field(3).type)], names=["_item", "score", "ids"])

    from pyspark.sql.pandas.types import to_arrow_type

    shared_type = to_arrow_type(cls.sparkSession.createDataFrame([], f"i {item_type}").schema["i"].dataType)
    return cls.select("m", "t", "f", "ids").mapInArrow(run, f"_item {item_type}, score long, ids {doc_type}")


def weight_table(terms: list[list[bytes]], vocabulary: dict[bytes, int], df: dict[int, int], n_docs: int) -> np.ndarray:
    """Weights by (term, item); 0 where the item lacks the term."""
    out = np.zeros((len(vocabulary), len(terms)), np.int64)
    for item, ts in enumerate(terms):
        for t in ts:
            k = vocabulary[t]
            out[k, item] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(k, 0) + 1)))
    return out


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item."""
    spark = docs.sparkSession
    item_type, doc_type = (d.schema[c].dataType.simpleString() for d, c in ((items, item_col), (docs, id_col)))
    out = spark.createDataFrame([], f"_item {item_type}, rank int, _id {doc_type}, score long")
    for ids, terms in item_blocks(items, item_col, item_text_col):
        vocabulary = {t: k for k, t in enumerate(sorted({t for ts in terms for t in ts}))}
        bag = materialize(bags(docs, vocabulary, id_col, text_col), "bags")
        n_docs, n_terms = bag.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        found = bag.select(F.explode("t").alias("t")).groupBy("t").count().collect()  # a row per term of the block
        weights = weight_table(terms, vocabulary, {r.t: r["count"] for r in found}, n_docs)
        best = best_classes(classes(bag, n_docs, n_terms, top), ids, weights, item_type, top)
        members = best.select("_item", "score", F.explode("ids").alias("_id"))
        order = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("_id").asc_nulls_last())
        ranked = members.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        out = out.unionByName(materialize(ranked.select("_item", "rank", "_id", "score"), "ranked"))
    return out.select(F.col("_item").alias(item_col), "rank", F.col("_id").alias(id_col), "score")


_ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws
  FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n, sum(len(ws))::BIGINT AS l FROM d WHERE len(ws) > 0),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term
  FROM benchmark),
w AS (SELECT r, unnest(ws) AS term FROM d),
c AS (SELECT r, term, count(*) AS tf FROM w GROUP BY r, term),
f AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM c, s
      GROUP BY term, n),
m AS (SELECT r, doc_id, 10 + (90 * len(ws) * n) // l AS m FROM d, s WHERE len(ws) > 0),
g AS (SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM i JOIN c USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY item_id, r)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r))::INT AS rank,
       doc_id, score
FROM g JOIN m USING (r) WHERE score > 0
QUALIFY rank <= {TOP}
"""


@register("op12_lexical_search", _ORACLE)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
