import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lathe.llm import sharding as sh
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"

ROWS = [(i, f"text {i % 90}", f"s{i % 3 if i % 2 else 0}" if i % 13 else None) for i in range(500)]
ROWS += [(None, "no id", "s1"), (None, None, None), (600, None, "s2"), (601, "", "alone"), (7, "same", "s1"),
         (7, "same", "s1"), (700, "é" * 300_000, "s2")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "doc_id long, text string, source string, _rank int, _Slot string")


def test_counts_slots_and_mixture(spark):
    out = sh.interleaved(frame(spark), shards=8).collect()
    assert out[0].asDict().keys() == {"doc_id", "text", "source", "_rank", "_shard", "_slot"}
    assert Counter((r.doc_id, r.text, r.source) for r in out) == Counter(ROWS)
    by = defaultdict(list)
    for r in out:
        by[r._shard].append(r)
    sizes = [len(by[j]) for j in range(8)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(ROWS)
    share = Counter(s for _, _, s in ROWS)
    for rows in by.values():
        assert sorted(r._slot for r in rows) == list(range(len(rows)))
        got = Counter(r.source for r in rows)
        for s, n in share.items():
            assert abs(got[s] - n * len(rows) / len(ROWS)) <= 2, s


def test_layout_does_not_matter_and_seed_does(spark):
    rows = [r for r in ROWS if r != (7, "same", "s1")]
    key = lambda df: {(r.doc_id, r.text): (r._shard, r._slot) for r in df.collect()}
    one = key(sh.interleaved(frame(spark, rows).repartition(1)))
    assert one == key(sh.interleaved(frame(spark, rows).repartition(9)))
    assert one != key(sh.interleaved(frame(spark, rows), seed=5))


def test_buckets_grow_with_rows(spark, monkeypatch):
    assert [sh._digits(n) for n in (0, 1, 2_560_000, 2_560_001, 10 ** 9, 10 ** 12)] == [2, 2, 2, 3, 4, 4]
    want = {(r.doc_id, r.text): (r._shard, r._slot) for r in sh.interleaved(frame(spark)).collect()}
    monkeypatch.setattr(sh, "BUCKET_ROWS", 1)
    assert want == {(r.doc_id, r.text): (r._shard, r._slot) for r in sh.interleaved(frame(spark)).collect()}


def test_hot_group_of_copies_and_fewer_rows_than_shards(spark):
    rows = [(i, "copy", "hot") for i in range(300)] + [(i, f"t{i}", "b") for i in range(300, 310)]
    sizes = Counter(r._shard for r in sh.interleaved(frame(spark, rows), shards=7).collect())
    assert len(sizes) == 7 and max(sizes.values()) - min(sizes.values()) <= 1
    few = sh.interleaved(frame(spark, ROWS[:3]), shards=8).collect()
    assert len({r._shard for r in few}) == 3 and all(r._slot == 0 for r in few)
    assert sh.interleaved(frame(spark, []), shards=8).count() == 0 and sh.shard_report(frame(spark, [])).count() == 0


def test_report_columns(spark):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in ROWS)
    rows = sh.shard_report(frame(spark)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)


def test_written_shards_hold_every_row_in_order(spark, tmp_path):
    path = str(tmp_path / "shards")
    sh.write_shards(frame(spark), path, shards=4)
    got = spark.read.parquet(path)
    assert got.count() == len(ROWS) and got.select("_shard").distinct().count() == 4
    files = got.withColumn("f", F.input_file_name()).groupBy("_shard", "f").agg(
        F.min("_slot").alias("lo"), F.max("_slot").alias("hi"), F.count("*").alias("n")).collect()
    assert all(r.hi - r.lo + 1 == r.n for r in files)


def test_query_matches_oracle(spark):
    status, detail = compare(spark, duck(SF), "op13", sh.op13_sharding, sh._oracle(), SF, check_types=True)
    assert status == "ok", detail
