from lathe.llm import preferences as pf
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"
SCHEMA = "pair_id long, turn long, role string, text string, prompt string, chunk int"


def plain(a, b):
    """Prompt, completions and spans of two turn lists by the plain rule."""
    say = lambda r, t: f"{pf.OPEN}{r or ''}\n{t or ''}{pf.CLOSE}"
    a, b = ([(r or "", t or "") for r, t in x] for x in (a, b))
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1

    def done(turns):
        out, spans = "", []
        for r, t in turns:
            start = len(out) + len(pf.OPEN) + len(r or "") + 1
            out += say(r, t)
            if r == pf.TRAINED:
                spans.append(f"{start}-{len(out)}")
        return out, ",".join(spans)

    return "".join(say(*x) for x in a[:n]), done(a[n:]), done(b[n:]), n


def pairs(spark, sides):
    df = [spark.createDataFrame([(p, k, r, t, "x", 1) for p, two in sides.items() for k, (r, t) in enumerate(two[s])], SCHEMA)
          for s in (0, 1)]
    return pf.preference_pairs(*df).orderBy("pair_id", "chunk").collect()


def test_against_the_plain_rule(spark):
    long = [("user", f"q{k}") if k % 2 == 0 else ("assistant", f"é answer {k}") for k in range(200)]
    sides = {
        1: ([("system", "s"), ("user", "u"), ("assistant", "yes")], [("system", "s"), ("user", "u"), ("assistant", "no")]),
        2: ([("user", "a")], [("user", "b")]),
        3: ([("user", "a"), ("assistant", "x")], [("user", "a"), ("assistant", "x")]),
        4: ([("user", "a"), ("assistant", "x"), ("user", "m")], [("user", "a")]),
        5: ([("user", None), (None, "t")], [("user", ""), (None, "t"), ("assistant", "")]),
        6: (long, long[:150] + [("user", "other")] + long[151:]),
    }
    got = {}
    for r in pairs(spark, sides):
        got.setdefault(r.pair_id, []).append(r)
    for p, (a, b) in sides.items():
        prompt, (c, cs), (r, rs), n = plain(a, b)
        rows = got[p]
        assert ("".join(x.prompt for x in rows), "".join(x.chosen for x in rows), "".join(x.rejected for x in rows),
                sum(x.prompt_turns for x in rows)) == (prompt, c, r, n)
        if len(rows) == 1:
            assert (rows[0].chosen_spans, rows[0].rejected_spans) == (cs, rs)
        for x in rows:
            for s in filter(None, x.chosen_spans.split(",")):
                i, j = map(int, s.split("-"))
                assert x.chosen[i:j].endswith(pf.CLOSE) and x.chosen[:i].endswith("assistant\n")
    assert len(got[6]) == 4 and len(got[1]) == 1


def test_swapped_answers_and_edges(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (2, 0, "user", "only a question"), (3, 0, "user", "q3"),
            (3, 1, "assistant", "mid"), (3, 2, "user", "more"), (3, 3, "assistant", "a3"), (None, 0, "assistant", "null id"),
            (5, None, "assistant", "no number"), (5, 0, "user", None), (6, 0, "assistant", "x"), (6, 0, "assistant", "x")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, chosen string")
    got = {(r.conv_id, r.turn): r.text for r in pf.swapped_answers(df).collect()}
    assert got[1, 1] == "a3" and got[3, 3] == "no number" and got[3, 1] == "mid" and got[2, 0] == "only a question"
    assert got[5, None] == "x" and got[6, 0] == "null id" and got[None, 0] == "a1"
    out = {r.conv_id: r for r in pf.preference_pairs(df, pf.swapped_answers(df), "conv_id").where("chunk = 0").collect()}
    assert out[2].chosen == out[2].rejected == "" and out[3].prompt_turns == 3
    assert pf.swapped_answers(df.limit(0)).count() == 0
    assert pf.preference_pairs(df.limit(0), pf.swapped_answers(df.limit(0)), "conv_id").count() == 0


def test_query_matches_oracle(spark):
    status, detail = compare(spark, duck(SF), "op5", pf.op5_preferences, pf._oracle(), SF, check_types=True)
    assert status == "ok", detail
