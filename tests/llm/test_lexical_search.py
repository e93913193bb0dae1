import math
import re
from collections import Counter

from pyspark.sql import functions as F

from lathe.llm import lexical_search as ls
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def brute(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, size = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for t, k in df.items()}
    out = []
    for item in {i for i, _ in items}:
        want = {t for i, text in items if i == item for t in terms(text)}
        got = []
        for i, b in bags:
            m = 100 - 90 + (90 * sum(b.values()) * n) // size
            s = sum(w[t] * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m)) for t in want if t in b)
            if s > 0:
                got.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(got)[:top])]
    return sorted(out, key=repr)


DOCS = [(i, " ".join(f"w{(i * j) % 17}" for j in range(1, 3 + i % 9))) for i in range(120)]
DOCS += [(1000 + i, "Hot copy of W3, w5; w5!") for i in range(60)] + [(3, "Hot copy of W3, w5; w5!")]  # one class
DOCS += [(2000, None), (2001, ""), (2002, " .,- \t"), (None, "w3 w5"), (None, "w3 w5"), (2003, "É w3é Ünder_w3"),
         (2004, "w1 " * 50_000), (2005, "unique2005")]
ITEMS = [(1, "w3 w5, and W5"), (2, "w1"), (3, "nothing matches"), (4, None), (5, ""), (None, "hot"), (6, "É under w3é"),
         (7, "w2 w4"), (7, "w6"), (8, "unique2005 w9")]


def frames(spark, docs=DOCS, items=ITEMS):
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, score int, _id int")
    return d, spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_brute_force(spark):
    d, i = frames(spark)
    want = brute(DOCS, ITEMS)
    assert rows(ls.search(d, i)) == want and len(want) > 50
    assert rows(ls.search(d.repartition(13), i, top=3)) == brute(DOCS, ITEMS, 3)


def test_blocks_of_the_query_set(spark, monkeypatch):
    monkeypatch.setattr(ls, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(ls, "SLICE", 3)
    d, i = frames(spark)
    assert len(list(ls.item_blocks(i, "item_id", "text"))) == 4  # items with terms: 1 2 3 6 7 8 and the one without id
    assert rows(ls.search(d, i)) == brute(DOCS, ITEMS)
    monkeypatch.setattr(ls, "BLOCK_ITEMS", 256)
    monkeypatch.setattr(ls, "BLOCK_TERMS", 3)
    assert len(list(ls.item_blocks(i, "item_id", "text"))) > 1 and rows(ls.search(d, i)) == brute(DOCS, ITEMS)


def test_copies_are_one_class_scored_once(spark):
    d, _ = frames(spark)
    vocabulary = {t.encode(): k for k, t in enumerate(["hot", "w3", "w5"])}
    bag = ls.bags(d, vocabulary, "doc_id", "text")
    got = ls.classes(bag, 190, 60_000).where(F.array_contains("t", 0)).collect()
    assert len(got) == 1 and got[0].ids == [3, *range(1000, 1009)] and list(got[0].f) == [1, 1, 2]
    # equal bag, other length: another class
    two = ls.bags(spark.createDataFrame([(1, "w3"), (2, "w3 x x x x x x x")], "doc_id long, text string"),
                  vocabulary, "doc_id", "text")
    assert ls.classes(two, 2, 9).count() == 2


def test_empty_tables(spark):
    d, i = frames(spark)
    for a, b in ((d.limit(0), i), (d, i.limit(0)), (d.where("doc_id in (2000, 2001, 2002)"), i)):
        out = ls.search(a, b)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_query_matches_oracle(spark):
    status, detail = compare(spark, duck(SF), "op12", ls.op12_lexical_search, ls._ORACLE, SF, check_types=True)
    assert status == "ok", detail
