import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lathe.llm import turn_repair as tr
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
PATTERN = re.compile(r"(s?(ua)+)?")


def marks(rows):
    """(gone, cut off) of (turn, role, text) rows, and the fault counts."""
    seen, out, n = set(), [], [0, 0, 0]
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            n[fault] += 1
        out.append((fault in (0, 1), fault == 2))
    return out, n


def every_repair(rows):
    """Least (cost, audit, text) over all edit sequences."""
    flags, _ = marks(rows)
    adds = [x for k in range(3) for x in itertools.product(("user", "assistant"), repeat=k)]
    spots = []
    for (_, role, text), (gone, cut) in zip(rows, flags):
        mine = [("D", 3, None)]
        if not gone:
            mine += [("K", cut, (role, text)), ("R", 2 + cut, ("user", text)), ("R", 2 + cut, ("assistant", text))]
        spots += [adds, mine]
    best = None
    for pick in itertools.product(*spots, adds):
        cost, audit, turns = 0, "", []
        for at, x in enumerate(pick):
            if at % 2 == 0:
                cost, audit, turns = cost + 2 * len(x), audit + "I" * len(x), turns + [(r, "") for r in x]
            else:
                cost, audit = cost + x[1], audit + x[0]
                turns += [x[2]] if x[2] else []
        if all(r[:1] in "sua" and r for r, _ in turns) and PATTERN.fullmatch("".join(r[0] for r, _ in turns)):
            got = (cost, audit, "\n".join(f"{r}:{t}" for r, t in turns))
            best = min(best or got, got)
    return best


def by_rows(rows):
    """Least (cost, audit, text) state by state, for longer conversations."""
    flags, _ = marks(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}

    def put(to, state, got):
        if state not in to or got < to[state]:
            to[state] = got

    def add(now):
        for _ in range(2):
            for s, (c, a, t) in list(now.items()):
                for role in ("user", "assistant"):
                    if (s, role[0]) in step:
                        put(now, step[s, role[0]], (c + 2, a + "I", (*t, f"{role}:")))
        return now

    for (_, role, text), (gone, cut) in zip(rows, flags):
        after = {}
        for s, (c, a, t) in add(best).items():
            put(after, s, (c + 3, a + "D", t))
            if not gone:
                if (s, role[:1]) in step:
                    put(after, step[s, role[:1]], (c + cut, a + "K", (*t, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if (s, new[0]) in step:
                        put(after, step[s, new[0]], (c + 2 + cut, a + "R", (*t, f"{new}:{text}")))
        best = after
    c, a, t = min(v for s, v in add(best).items() if s in ("", "a"))
    return c, a, "\n".join(t)


def report(rows, least):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {r[0] for r in rows if r[0] is not None}
    cost, audit, text = least(rows)
    bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *marks(rows)[1], bad, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


TEXTS = ["Yes.", "No!", "cut off", "", " \t\n", "Really? ", "same.", "é…", "x" * 50 + "."]
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", "User", "a"]


def talk(rng, n):
    return [(t if rng.random() < 0.9 else None, rng.choice(ROLES), rng.choice(TEXTS)) for t in range(n)]


def test_auction_equals_all_edit_sequences():
    rng = random.Random(7)
    for n in (0, 1, 2, 2, 2, 3, 3, 3):
        rows = talk(rng, n)
        got, edits = tr.whole([(*r, False) for r in rows])
        cost, audit, text = every_repair(rows)
        assert (got[5], got[6], got[7]) == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), rows
        assert by_rows(rows) == (cost, audit, text)


def test_auction_equals_state_by_state_search(monkeypatch):
    rng = random.Random(11)
    for n in [*range(1, 40), 150]:
        rows = [(t, rng.choice(ROLES[:6]), f"{rng.choice(TEXTS)}{t if rng.random() < 0.7 else ''}.") for t in range(n)]
        got, _ = tr.whole([(*r, False) for r in rows])
        cost, audit, text = by_rows(rows)
        assert (got[5], got[6], got[7]) == (cost, audit, hashlib.sha256(text.encode()).hexdigest())
    monkeypatch.setattr(tr, "BLOCK", 1)
    assert tr.whole([(*r, False) for r in rows])[0][5:7] == (cost, audit)


def test_prices_are_dual_feasible_and_tight_on_the_path():
    arcs, end = tr.lattice([tr.STAGES[c] for c in "oUsuxaAuu"], tr.END_COSTS)
    prices = [0] * (end + 1)
    tr.auction(arcs, prices, 0, end)
    assert all(prices[i] <= cost + prices[j] for i, mine in enumerate(arcs) for _, cost, j in mine)
    labels, state = tr.walk(arcs, prices, 0, end)
    assert prices[0] == tr.solve("oUsuxaAuu")[0][0] and state in (0, 2, 3) and labels


def frame(spark, convs, n=5):
    rows = [(c, *r, 1, "x") for c, rs in convs for r in rs]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, _part int, Cost string").repartition(n)


def want_of(convs, least=by_rows):
    by = defaultdict(list)
    for c, rs in convs:
        by[c] += [(t, role if role is not None else " ", text if text is not None else " ") for t, role, text in rs]
    return sorted([(c, *report(rs, least)) for c, rs in by.items()], key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def convs():
    rng = random.Random(3)
    out = [(c, talk(rng, rng.randrange(1, 9))) for c in range(60)]
    out.append((900, [(t, rng.choice(ROLES[:5]), f"{t % 90}{rng.choice(TEXTS)}") for t in range(700)]))  # over many ranges
    out.append((901, [(1, "user", "one and the same row.")] * 300))
    out += [(None, talk(rng, 5)), (902, [(None, None, None)]), (903, [(2, "user", None), (1, None, "Fine.")]),
            (904, [(1, "user", "w " * 200_000 + "."), (2, "assistant", "ok.")]), (905, [(-5, "user", "a."), (4, "assistant", "b.")])]
    return out


def test_report_equals_plain_search(spark, convs):
    assert result(tr.repair_report(frame(spark, convs))) == want_of(convs)


def test_long_conversation_over_every_range(spark, convs):
    long = [x for x in convs if x[0] in (900, 901, 903)]  # nearly all rows lie at borders
    assert result(tr.repair_report(frame(spark, long, 1))) == want_of(long)


def test_repaired_turns_make_the_hash(spark, convs):
    got = defaultdict(list)
    for r in tr.repaired_turns(frame(spark, convs)).orderBy("_part", "_seq").collect():
        got[r.conv_id].append(f"{r.role}:{r.text}")
    for r in tr.repair_report(frame(spark, convs)).collect():
        assert hashlib.sha256("\n".join(got[r.conv_id]).encode()).hexdigest() == r.repaired_sha256
        assert PATTERN.fullmatch("".join(x[0] for x in got[r.conv_id]))


def test_damage(spark):
    rows = [(c, t, "assistant", "Well. Yes! No?") for c in range(30) for t in range(5)] + [(None, None, None, None)]
    got = defaultdict(list)
    for r in tr.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        got[r.conv_id, r.turn].append((r.role, r.text, r._alive))
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        want = {0: [(role, "", False)], 1: [(role, "", True)], 2: [(role, "Well Yes No", True)], 3: [(role, text, True)] * 2,
                4: [("user", text, True)]}.get(kind, [(role, text, True)])
        assert got[c, t] == want


def test_dropped_conversations_and_empty_table(spark):
    gone = spark.createDataFrame([(1, 1, "user", "a.", False), (1, 2, "user", "b.", False), (2, 1, "user", "c.", True)],
                                 "conv_id long, turn long, role string, text string, alive boolean")
    empty = hashlib.sha256(b"").hexdigest()
    got = result(tr.repair_report(gone, alive="alive"))
    assert got[0] == (1, 0, 0, 0, 0, 0, 0, "", empty) and got[1][0] == 2 and len(got) == 2
    assert tr.repair_report(gone.limit(0)).count() == 0 and tr.repaired_turns(gone.limit(0)).count() == 0


def test_query_matches_oracle(spark):
    status, detail = compare(spark, duck(SF), "op11", tr.op11_turn_repair, tr._oracle(), SF, check_types=True)
    assert status == "ok", detail
