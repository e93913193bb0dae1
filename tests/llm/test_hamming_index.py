import numpy as np

from lathe.llm import hamming_index as hi

SF = "/root/testdata/sf0.01"


def brute(rows, every=50, k=5):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault(i, np.array(v, np.float64))
    n = {i: v / np.linalg.norm(v) for i, v in ok.items()}
    out = {}
    for q in (i for i in n if i % every == 0):
        out[q] = sorted((-round(float(n[q] @ v), 12), i) for i, v in n.items() if i != q)[:k]
    return out


def test_probes_meet_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    q, c = (rng.integers(0, 256, (n, 6), dtype=np.uint8) for n in (20, 300))
    h = hi.distances(q, c)
    for r in (0, 3, 5, 11, 17, 48):
        a, b = hi.within(q, c, r)
        assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(h <= r))))


def test_codes_longer_than_a_byte_counts_are_compared_in_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(2)
    q, c = (rng.integers(0, 256, (n, 37), dtype=np.uint8) for n in (200, 4000))
    q[:, 0] = c[:, 0] = 7  # one bucket holds all codes
    c[0] = ~q[0]  # 296 bits apart but for the first byte
    c[0, 0] = 7
    assert hi.distances(q[:1], c[:1])[0, 0] == 288
    tracemalloc.start()
    try:
        a, b = hi.within(q, c, 120)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    want = np.nonzero(np.unpackbits(q[:, None, :] ^ c[None, :, :], axis=2).sum(axis=2) <= 120)
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(*(x.tolist() for x in want)))
    assert peak < 20e6, peak


def test_recall_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows)
    got = hi.op3_hamming_index(spark, SF).collect()
    assert len(got) == 5 * len(want)
    hit = 0
    for r in got:
        truth = {i: -s for s, i in want[r.query_id]}
        hit += r.vec_id in truth
        if r.vec_id in truth:
            assert abs(r.score - truth[r.vec_id]) < 1e-9
    assert hit >= 0.9 * len(got)
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert all(x == sorted(x) and len(x) == 5 for x in by.values())


def test_edge_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((40, 8)).tolist()
    rows = [(i, x) for i, x in enumerate(v)]
    rows += [(100 + i, v[3]) for i in range(60)] + [(50, v[3])]  # a vector that fills the table
    rows += [(200, None), (250, [0.0] * 8), (300, [float("nan")] * 8), (350, [None, *v[0][1:]]), (400, [float("inf")] * 8),
             (450, [1.0, 2.0]), (None, v[1]), (7, v[7]), (500, [x * 1e-200 for x in v[5]])]
    df = spark.createDataFrame([(*r, 1, 0.0) for r in rows], "vec_id long, embedding array<double>, rank int, score double")
    monkeypatch.setattr(hi, "COVER", 1.0)
    got = hi.nearest(df).collect()
    want = brute([(i, x) for i, x in rows if x is None or len(x) == 8 and i != 500] + [(500, v[5])])
    have = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        have.setdefault(r.query_id, []).append((-round(r.score, 12), r.vec_id))
    assert set(have) == set(want) == {0, 50, 100, 150, 500}
    assert have[50] == want[50] and have[150] == want[150]
    assert sum(len({i for _, i in have[q]} & {i for _, i in want[q]}) for q in want) >= 0.9 * 25
    few = hi.nearest(df.where("vec_id in (0, 1, 2)")).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(0, 1), (0, 2)]
    assert hi.nearest(df.limit(0)).count() == 0 and hi.nearest(df.where("vec_id = 50")).count() == 0
