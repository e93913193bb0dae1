import hashlib
import random
import re

from pyspark.sql import functions as F

from lathe.llm import winnowing as wn

SF = "/root/testdata/sf0.001"


def edits(rows):
    """(id, text) rows -> {(id, text): (edited, next text)} by the plain rule."""
    rows = [(i, t or "") for i, t in rows]
    order = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i))
    nxt = {i: order[(p + 1) % len(order)] for p, i in enumerate(order)}
    least = {i: min(t for j, t in rows if j == i) for i in order}
    out = {}
    for i, t in rows:
        c = len(t) // 4
        out[i, t] = (t[:len(t) - c] + least[nxt[i]][:c], least[nxt[i]])
    return out


def prints(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return {r.i: r for r in df.select("i", wn.token_hashes(F.col("t")).alias("h"),
                                      wn.fingerprint(F.col("t")).alias("fp")).collect()}


def test_windows_by_brute_force(spark):
    texts = ["", "one", "a b c", "x y z q", "la " * 50, "the quick brown fox jumps over the lazy dog " * 3, "z" * 100,
             " ".join(str(i * 7 % 13) for i in range(90))]
    gram = {}
    for i, r in prints(spark, texts).items():
        toks = re.findall(r"[^\x20\x09-\x0D]{1,16}", texts[i])
        assert len(r.h) == len(toks)
        got = [(x >> 32, wn._LOW - (x & wn._LOW)) for x in r.fp]
        for h, p in got:  # equal grams have equal hashes
            assert gram.setdefault(tuple(toks[p:p + wn.K]), h) == h
        n = max(len(toks) - wn.K + 1, min(len(toks), 1))
        assert bool(got) == bool(toks) and all(0 <= p < n for _, p in got)
        chosen = {p for _, p in got}
        for s in range(max(n - wn.W + 1, min(n, 1))):  # every window holds a chosen gram: the rightmost smallest
            inside = [(h, -p) for h, p in got if s <= p < s + wn.W]
            assert inside and -min(inside)[1] in chosen


def test_rightmost_of_equal_grams(spark):
    fp = prints(spark, ["la " * 50])[0].fp
    assert [wn._LOW - (x & wn._LOW) for x in fp] == list(range(wn.W - 1, 47))


def test_shared_run_is_found(spark):
    run = " ".join(f"w{i}" for i in range(wn.K + wn.W - 1))
    got = prints(spark, [f"aa bb cc {run} dd", f"zz {run} yy xx ww vv uu"])
    assert {x >> 32 for x in got[0].fp} & {x >> 32 for x in got[1].fp}


def test_a_character_inserted_into_unspaced_text(spark):
    rng = random.Random(5)
    for letters in (range(0x4E00, 0x9FA0), range(0x3041, 0x3097), range(0x0E01, 0x0E5B), range(0xAC00, 0xD7A4),
                    [*range(48, 58), *range(97, 123)]):
        text = "".join(chr(rng.choice(letters)) for _ in range(800))
        got = prints(spark, [text, text[:5] + "x" + text[5:], text[:5] + text[6:], "x " + text])
        a, *others = ({x >> 32 for x in got[i].fp} for i in range(4))
        assert len(a) > 10 and all(len(a & b) >= 0.8 * len(a | b) for b in others)
    words = "zu Donaudampfschifffahrt gehen, siebzehnzeichen1 sechzehnzeichen1 a"  # short runs stay whole
    tokens = [t for t in words.split() if len(t) <= wn.PIECE]
    want = spark.createDataFrame([(t,) for t in tokens], "t string").select(F.xxhash64("t")).collect()
    assert {r[0] for r in want} <= set(prints(spark, [words])[0].h)


def test_edge_rows(spark):
    rows = [(3, "one two three four five six seven eight"), (1, None), (7, ""), (7, "Ünï cödé tëxt, hère"), (None, "null id"),
            (3, "one two three four five six seven eight"), (9, "tail " * 3000), (12, "q")]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, fingerprint string, near_next double")
    got = wn.fingerprints_with_edits(df).collect()
    want = edits(rows)
    assert len(got) == len(rows)
    sums = sorted((r.doc_id is not None, r.doc_id, r.n_chars, r.edited_sha256) for r in got)
    assert sums == sorted((i is not None, i, len(t or ""), hashlib.sha256(want[i, t or ""][0].encode()).hexdigest())
                          for i, t in rows)
    by = {(r.doc_id, r.n_chars): r for r in got}
    assert by[1, 0].fingerprint == "" and by[1, 0].near_edited == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert wn.fingerprints_with_edits(df.limit(0)).count() == 0
    one = wn.fingerprints_with_edits(df.where("doc_id = 12")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_query_against_the_plain_rule(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = edits(docs)
    got = wn.op6_winnowing(spark, SF).collect()
    assert len(got) == len(docs)
    texts = dict(docs)
    by_text = {}
    for r in got:
        t = texts[r.doc_id] or ""
        edited, nxt = want[r.doc_id, t]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        a, b = ({x.split("@")[0] for x in f.split()} for f in (r.fingerprint, r.edited_fingerprint))
        assert abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-12
    long = [r for r in got if r.n_chars > 800]
    assert sum(r.near_edited > 0.4 for r in long) > 0.9 * len(long)
    plan = wn.op6_winnowing(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if k in plan]
