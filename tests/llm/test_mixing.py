import re
from collections import defaultdict

from pyspark.sql import functions as F

from lathe.llm import mixing as mx
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def water(sizes):
    """Targets by the plain rounds: cap, share the excess again, repeat."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: mx.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, capped = mx.SHARE * sum(sizes.values()), set()
    while True:
        rest = total - sum(mx.CAP * sizes[s] for s in capped)
        free = sum(w[s] for s in names if s not in capped)
        t = {s: mx.CAP * sizes[s] if s in capped else rest * w[s] / free for s in names}
        over = {s for s in names if t[s] > mx.CAP * sizes[s]}
        if not over:
            return t
        capped |= over


ROWS = [(i, "a b c d " * (i % 7 + 1), f"s{i % 5}" if i % 11 else None) for i in range(400)]
ROWS += [(1000 + i, None, "s0") for i in range(3)] + [(2000, "", "empty"), (None, "no id here", "s1"), (4000, "same row", "s2"),
                                                      (4000, "same row", "s2"), (3000, "long " * 20_000, "é big")]


def frame(spark):
    return spark.createDataFrame([(*r, 1, "x") for r in ROWS], "doc_id long, text string, source string, target int, words string")


def test_targets_and_taken(spark):
    sizes = defaultdict(int)
    for _, t, s in ROWS:
        sizes[s] += words(t)
    want = water(sizes)
    rows = mx.mix_report(frame(spark)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in rows)
    got = defaultdict(int)
    by_id = defaultdict(list)
    for i, t, s in ROWS:
        by_id[i].append((words(t), s))
    for r in rows:
        n, s = by_id[r.doc_id][0]
        assert r.size == n and r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-5
        got[s] += r.taken
    for s in sizes:
        assert abs(got[s] - want[s]) <= 0.5 + 1e-6, s
    again = mx.mix_report(frame(spark).repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.taken, r.shards)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mixed_rows_follow_the_report(spark):
    df = frame(spark)
    out = mx.mixed(df)
    assert out.columns == [*df.columns, "_shard", "_shuffle_key"]
    drawn = {r.doc_id: r for r in out.groupBy("doc_id").agg(
        F.sum(mx.word_count(F.coalesce("text", F.lit("")))).alias("n"), F.sort_array(F.collect_list("_shard")).alias("s")).collect()}
    for r in mx.mix_report(df).where("doc_id is not null and doc_id != 4000 and size > 0").collect():
        got = drawn.get(r.doc_id)
        assert (got.n if got else 0) == r.taken
        assert sorted(map(int, r.shards.split(","))) == got.s if r.shards else got is None


def test_splitting_tree_keeps_quotas(spark):
    sized = frame(spark).select("doc_id", "source", mx.word_count(F.coalesce("text", F.lit(""))).alias("size"))
    plan = mx.quotas(sized).where("shards is not null")
    drawn = plan.select(F.explode("shards").alias("shard")).groupBy("shard").count().collect()
    n = [r["count"] for r in drawn]
    assert len(n) == mx.SHARDS and max(n) - min(n) <= 1


def test_empty_table_and_wordless_table(spark):
    assert mx.mix_report(frame(spark).limit(0)).count() == 0 and mx.mixed(frame(spark).limit(0)).count() == 0
    rows = mx.mix_report(frame(spark).where("doc_id >= 1000 and doc_id <= 2000")).collect()
    assert len(rows) == 4 and all(r.taken == r.size == r.source_size == 0 and r.target == 0 for r in rows)


def test_query_matches_oracle(spark):
    status, detail = compare(spark, duck(SF), "op8", mx.op8_mixing, mx._oracle(), SF, check_types=True)
    assert status == "ok", detail
