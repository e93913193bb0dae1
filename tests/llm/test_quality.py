import numpy as np
import pytest
from pyspark.sql import functions as F

from lathe.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_features_by_hand(spark):
    df = spark.createDataFrame([("Ab c\nAb c!",), ("",), ("| | |",)], "t string").select(q.features(F.col("t")).alias("x"))
    a, empty, pipes = ([dict(zip(q.FEATURES, r.x, strict=True)) for r in df.collect()])
    assert a["upper"] == pytest.approx(2 / 10) and a["bang"] == pytest.approx(1 / 4) and a["new_words"] == pytest.approx(3 / 4)
    assert a["new_lines"] == 1.0 and a["new_runs"] == 1.0 and a["size"] == pytest.approx(np.log(4))
    assert set(empty.values()) == {0.0} and pipes["pipe"] == 1.0


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    half = F.xxhash64("doc_id") % 2 == 0
    got = q.scored(docs, labels.where(half)).join(labels.where(~half), F.col("_id") == F.col("doc_id")).collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.15


def test_sites_shrink_toward_the_global_rate(spark):
    docs = [(i, ("Good plain words in a line of text, number %d." % i) if i % 10 else "BAD!! " * 30, f"h{i % 4}", "en") for i in range(400)]
    docs += [(1000 + i, "BAD!! " * 30 + str(i), "junk", "en") for i in range(100)] + [(2000, "Good plain words, one more.", "lone", "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int("Good" in t), 0) for i, t, _, _ in docs], "doc_id long, quality int, toxic int")
    rate = {r._id: r.site_rate for r in q.scored(df, labels).collect()}
    overall = np.mean(["Good" in t for _, t, _, _ in docs])
    assert rate[1000] < 0.3 < overall < rate[1] and abs(rate[2000] - overall) < 0.15


def test_edges_and_stage_columns(spark):
    rows = [(1, None, None, None), (2, "", "a", "en"), (None, "no id at all", "a", None), (3, "twice", "b", "en"), (3, "twice", "b", "en"),
            (4, "word " * 50_000, "b", "en")]
    df = spark.createDataFrame([(*r, 0.5, True) for r in rows], "doc_id long, text string, source string, lang string, posterior double, kept boolean")
    none = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    got = q.scored(df, none).collect()
    assert len(got) == len(rows) and all(r.kept and r.evidence == 0 for r in got)
    out = q.accepted(df, none)
    assert out.columns == df.columns and out.count() == len(rows)
    assert q.scored(df.limit(0), none).count() == 0 and q.accepted(df.limit(0), none).count() == 0


def test_query_keeps_clean_documents(spark):
    got = {r.doc_id: r for r in q.op4_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == 1000 and all(0 < r.site_rate < 1 and r.kept == (r.posterior >= q.KEEP) for r in got.values())
    assert np.mean([got[r.doc_id].kept for r in labels if r.quality == 1]) > 0.98
    assert np.mean([got[r.doc_id].kept for r in labels if r.quality == 0]) < 0.1


def test_one_text_in_a_good_and_a_bad_source_is_judged_in_each(spark):
    rows = [(r._id, r._text, r._host, r._path, r.kept) for r in _judged_in_two_sites(spark)]
    assert len({k for *_, k in rows}) == 2
    df, labels = _two_sites(spark)
    kept = sorted((r.doc_id, r.source) for r in q.accepted(df, labels).collect())
    assert kept == sorted((i, h) for i, _, h, _, k in rows if k)


def _two_sites(spark):
    """Equal ids and texts in a source of good and one of bad texts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = docs.join(labels, "doc_id").withColumn("source", F.when(F.col("quality") == 1, "fine").otherwise("junk"))
    both = known.select("doc_id", "text", F.explode(F.array(F.lit("fine"), F.lit("junk"))).alias("source"), "lang")
    return known.select("doc_id", "text", "source", "lang").union(both.where("doc_id % 10 = 0")).distinct(), labels


def _judged_in_two_sites(spark):
    df, labels = _two_sites(spark)
    rows = df.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.col("source").alias("_host"),
                     F.col("lang").alias("_path"))
    key = q.row_key("_id", "_text", "_host", "_path")
    verdict = q.scored(df, labels).select("_row", "kept")
    return rows.withColumn("_row", key).join(verdict, "_row").collect()
