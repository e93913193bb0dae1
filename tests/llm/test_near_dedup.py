import re
from collections import Counter
from itertools import combinations

import numpy as np

from lathe.llm import near_dedup as nd

SF = "/root/testdata/sf0.01"


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(id, text) rows -> [(id, n, component)] by all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    at = {}
    for k, s in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(k)
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    seen = set()
    for ks in at.values():
        for a, b in combinations(ks, 2):
            if (a, b) not in seen:
                seen.add((a, b))
                n = len(sets[a] & sets[b])
                if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                    root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)]


def rows_of(df):
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=order)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0))


def test_query_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = nd.op9_near_dedup(spark, SF)
    assert rows_of(got) == ordered(brute(docs))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_superminhash_estimates_and_folds():
    rng = np.random.default_rng(2)
    errors = []
    for share in (0.2, 0.5, 0.75, 0.95):
        for n in (3, 40, 600):
            for _ in range(8):
                both = rng.integers(0, 2**63, max(1, int(n * share)), dtype=np.uint64)
                a, b = (np.concatenate([both, rng.integers(0, 2**63, n, dtype=np.uint64)]) for _ in "ab")
                sig = nd.superminhash(np.concatenate([a, b]), np.repeat([0, 1], len(a)), 2)
                errors.append((sig[0] == sig[1]).mean() - len(both) / (2 * n + len(both)))
                half = len(a) // 2
                parts = [nd.superminhash(x, np.zeros(len(x), np.intp), 1) for x in (a[:half], a[half:]) if len(x)]
                assert (np.minimum.reduce(parts)[0] == sig[0]).all()
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.045


def test_chains_large_groups_and_edges(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 8 * nd.MEMBER)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows, text = [], list(base)
    for k in range(25):  # a chain: neighbours near, ends far apart
        rows.append((100 + k, " ".join(text)))
        text[(k * 17) % 100:(k * 17) % 100 + 3] = [f"x{k}a", f"x{k}b", f"x{k}c"]
    rows += [(500 + k, " ".join(base)) for k in range(40)]
    shared = [f"s{i}" for i in range(150)]  # many documents with half of their words in common
    rows += [(1000 + k, " ".join(shared + [f"o{k}_{i}" for i in rng.integers(0, 500, 110)])) for k in range(60)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "Two words"), (2004, "two WORDS"), (None, "two words"), (2005, "a"),
             (2006, " ".join(base).upper()), (7, "same same"), (7, "same same"), (7, "another text"), (None, "alone without id"),
             (9000, "long " * 30_000 + " ".join(f"z{i}" for i in range(50_000)))]
    df = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id long, text string, n_shingles string, kept boolean")
    assert rows_of(nd.near_dedup(df)) == ordered(brute(rows))
    left = nd.without_duplicates(df)
    assert left.columns == df.columns
    kept = [(r.doc_id, r.text) for r in left.collect()]
    groups = {c for _, n, c in brute(rows) if n and c is not None}
    assert sorted(i for i, t in kept if shingles(t) and i is not None and i != 7) == sorted(groups - {7})
    assert sum(i == 7 for i, _ in kept) in (1, 2) and sum(not shingles(t) for _, t in kept) == 3
    assert nd.near_dedup(df.limit(0)).count() == 0 and nd.without_duplicates(df.limit(0)).count() == 0


def kept_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return Counter((r.doc_id, r.text) for r in nd.without_duplicates(df).collect())


def test_one_row_of_each_component_stays_where_components_share_an_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(7, a), (7, a), (8, a + " end"), (7, b), (7, c), (6, c + " end"), (7, "another text"), (9, "another TEXT")]
    assert kept_rows(spark, rows) == Counter([(7, a), (7, b), (6, c + " end"), (7, "another text")])


def test_groups_without_ids_keep_one_row(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(80)) for x in "abcd")
    got = kept_rows(spark, [(None, a)] * 5 + [(None, b), (None, b + " end"), (None, b + " END"), (None, c), (9, c + " end"),
                            (4, c + " end"), (None, d), (None, None), (None, None), (None, " "), (None, "alone")])
    near = {t for _, t in got if t in (b, b + " end", b + " END")}
    assert len(near) == 1
    assert got == Counter([(None, a), (None, *near), (4, c + " end"), (None, d), (None, None), (None, None), (None, " "),
                           (None, "alone")])
    assert sum(kept_rows(spark, [(None, x) for x in (b, b + " end", b + " END")] * 2).values()) == 1


def test_a_large_group_of_near_copies_emits_fewer_links_than_rows(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 100 * nd.MEMBER)
    made, plain = {}, nd.materialize

    def counted(df, name):
        out = plain(df, name)
        made.setdefault(name, out.count())
        return out

    monkeypatch.setattr(nd, "materialize", counted)
    rng = np.random.default_rng(9)
    rows = []
    for k in range(700):  # each has 2 of 120 words changed: some pairs are near, some just are not
        words = [f"w{i}" for i in range(120)]
        for i in rng.integers(0, 120, 2):
            words[i] = f"c{k}_{i}"
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(nd.near_dedup(df)) == ordered(brute(rows))
    assert made["pairs"] < 700 and made["links"] < 700


def test_spanning_links_of_two_blocks():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**62, 200)
    sets = [np.unique(np.concatenate([base[:-6], rng.integers(0, 2**62, 6)])) for _ in range(400)]
    sets += [np.unique(np.concatenate([base[:130], rng.integers(0, 2**62, 70)])) for _ in range(30)]  # near to none
    digest = [k.to_bytes(16, "big") for k in rng.permutation(len(sets)).tolist()]
    n = len(sets)
    wide = [nd._signatures([s.astype(np.uint64)], nd.WIDE)[0] for s in sets]
    rows = nd.pa.RecordBatch.from_arrays([
        nd.pa.array([5] * n), nd.pa.array([0] * n), nd.pa.array([0] * n), nd.pa.array([True] * n), nd.pa.array([True] * n),
        nd.pa.array([True] * n), nd.pa.array(digest), nd.pa.array(digest), nd.pa.array([len(s) for s in sets]),
        nd._as_bytes(np.array(wide)), nd.pa.array([s.tolist() for s in sets], nd.pa.list_(nd.pa.int64()))],
        names=["bucket", "_i", "_j", "_left", "_right", "_minor", "digest", "comp", "n", "wide", "members"])
    for cut in (n, 150):  # in one batch, and carried over batches
        found = [uv for b in nd._near_in_blocks(rows.slice(i, cut) for i in range(0, n, cut)) for uv in b.to_pylist()]
        root = {d: d for d in digest}

        def find(d):
            while root[d] != d:
                d = root[d]
            return d

        for uv in found:
            assert find(uv["u"]) != find(uv["v"])  # a forest
            root[find(uv["u"])] = find(uv["v"])
        assert len(found) == 399 and len({find(d) for d in digest[:400]}) == 1


def test_survivor_of_equal_texts_does_not_depend_on_the_order_of_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, s, None) for s in ("s3", "s1", None, "s2")]
    got = {tuple(r) for order in (rows, rows[::-1], rows[2:] + rows[:2]) for r in nd.without_duplicates(
        spark.createDataFrame(order, "doc_id long, text string, source string, lang string").repartition(3)).collect()}
    assert len(got) == 1


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 102)], "u int, v int")
    got = {r.u: r.v for r in nd.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 102: 100}
