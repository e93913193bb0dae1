"""Conversation structure repair as a shortest path, found by the auction algorithm.

A conversation's rows in order are the stages of a lattice. Its states say
which role the pattern ``(s?(ua)+)?`` of role initials allows next. Edits are
arcs: Delete a row (cost 3), Insert an empty user or assistant turn (2), Keep a
row whose initial the state allows (0, or 1 where its text is cut off), Rerole
a row to the role that the state allows (2, or 3). Blank and duplicate rows
have no arc but Delete.

``auction`` is Bertsekas' forward algorithm: a path grows from the entry; its
end node's price rises to the least of arc cost plus next price, which takes
the node back off the path (contraction), or, where the price already equals
it, the path is extended along that arc. Costs are integers, so prices stop
when the path meets the exit. Every shortest path then runs on tight arcs
(price = cost + next price); ``walk`` follows, among tight arcs that lead to
the exit, the one with the ASCII-least initial. A state and an initial name one
next state, so the least initials name one repair.

Lattices of more than ``BLOCK`` stages are solved in blocks from the end: the
prices at a block's start are the exit costs of the block before.

Scale: rows are dealt by range of (conversation, order), so a conversation of
any share of the rows is spread over as many tasks as its rows need. A task
solves the conversations that lie wholly inside its range. The first and last
of each range (``border`` rows) are solved in three steps: each chunk becomes
one stage of four states (costs from entry to exit, exits ranked by their least
initials), a lattice of these stages gives each chunk its entry and exit, and
the chunks write their repaired turns, which are hashed as a sorted stream. A
conversation's audit and hash are one value each, so only they see all of it.

Defined results: rows of a conversation are ordered by (turn, null first, role,
text); a null role or text is one space, a null conversation id is a
conversation; a role of other initials (or none) can be kept nowhere; repeated
rows are duplicates; a conversation without rows has zeros, an empty audit and
the empty text's hash; an empty table gives an empty result; other columns are
ignored; texts are taken whole.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import table
from lathe.llm.registry import register
from lathe.session import materialize

DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
BLOCK = 32  # stages of a lattice solved at a time
SPACE = " \t\n\v\f\r"
ADDS = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}  # role and state after it
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = {0: "", 1: "II", 2: "I", 3: ""}  # inserts after the last row
END_COSTS = tuple(INSERT * len(ENDS[s]) for s in range(4))


def _stage(code: str) -> tuple:
    """Arcs (label, cost, stages forward, state) of each state at a row.
    ``x``: must go; else its initial (``o``: any other), capital where cut off."""
    cut = CUT_OFF * code.isupper()
    arcs = []
    for s in range(4):
        mine = [("D", DELETE, 1, s), ("I", INSERT, 0, ADDS[s][1])]
        if code != "x":
            if (s, code.lower()) in KEEPS:
                mine.append(("K", cut, 1, KEEPS[s, code.lower()]))
            mine.append(("R", REROLE + cut, 1, ADDS[s][1]))
        arcs.append(tuple(mine))
    return tuple(arcs)


STAGES = {c: _stage(c) for c in "xsuaoSUAO"}


def lattice(stages, exits) -> tuple[list, int]:
    """Arcs (label, cost, node) by node (4 * stage + state) and the exit node;
    arcs that cannot reach it are left out. An exit cost of None is closed."""
    end = 4 * len(stages) + 4
    arcs = [[] for _ in range(end)] + [[]]
    live = [False] * end + [True]
    for s, cost in enumerate(exits):
        if cost is not None:
            arcs[end - 4 + s], live[end - 4 + s] = [("", cost, end)], True
    for i in reversed(range(len(stages))):
        for _ in range(3):  # an insert stays in its stage; two of them reach every state they can
            for s in range(4):
                live[4 * i + s] = any(live[4 * (i + step) + t] for _, _, step, t in stages[i][s])
        for s in range(4):
            arcs[4 * i + s] = [(label, cost, j) for label, cost, step, t in stages[i][s] if live[j := 4 * (i + step) + t]]
    return arcs, end


def auction(arcs: list, prices: list[int], origin: int, end: int) -> None:
    """Raises ``prices`` until ``prices[origin]`` is its distance to ``end``.
    Prices must never exceed arc cost plus next price; 0 will do."""
    path = [origin]
    while path[-1] != end:
        node = path[-1]
        least, to = min((cost + prices[j], j) for _, cost, j in arcs[node])
        if prices[node] < least:
            prices[node] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


def walk(arcs: list, prices: list[int], origin: int, end: int) -> tuple[list, int]:
    """Labels of the least tight path from ``origin``, and the state it ends in."""
    back: dict[int, list[int]] = {}
    for i, mine in enumerate(arcs):
        for _, cost, j in mine:
            if prices[i] == cost + prices[j]:
                back.setdefault(j, []).append(i)
    leads, todo = {end}, [end]
    while todo:
        for i in back.get(todo.pop(), ()):
            if i not in leads:
                leads.add(i)
                todo.append(i)
    labels, node = [], origin
    while True:
        label, to = min((label, j) for label, cost, j in arcs[node] if j in leads and prices[node] == cost + prices[j])
        if to == end:
            return labels, node % 4
        labels.append(label)
        node = to


def _block(stages, exits) -> list:
    """(distance, labels, exit state) of each entry state; None where no path is."""
    arcs, end = lattice(stages, exits)
    prices = [0] * (end + 1)
    out = []
    for s in range(4):
        if arcs[s]:
            auction(arcs, prices, s, end)
    for s in range(4):
        out.append((prices[s], *walk(arcs, prices, s, end)) if arcs[s] else None)
    return out


@functools.lru_cache(maxsize=50_000)
def _rows_block(codes: str, exits: tuple) -> list:
    return _block([STAGES[c] for c in codes], exits)


def solve(stages, exits=END_COSTS) -> list:
    """(distance, labels, exit state) from each entry state through all of
    ``stages`` (a text of row codes, or arcs), or None."""
    of = _rows_block if isinstance(stages, str) else _block
    done, costs = [], tuple(exits)
    for at in reversed(range(0, max(len(stages), 1), BLOCK)):
        low = min(c for c in costs if c is not None)
        got = of(stages[at:at + BLOCK], tuple(None if c is None else c - low for c in costs))
        costs = tuple(None if g is None else g[0] + low for g in got)
        done.append(got)
    out = []
    for s in range(4):
        labels, state = [], s
        for got in reversed(done) if costs[s] is not None else ():
            labels += got[state][1]
            state = got[state][2]
        out.append(None if costs[s] is None else (costs[s], labels, state))
    return out


def _initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "o"


def faults(rows, seen=None) -> tuple[str, int, int, int]:
    """Row codes, and the blank, duplicate and cut-off rows, of (turn, role,
    text, seen before) rows."""
    codes, blank, twice, cut, seen = [], 0, 0, 0, set()
    for _, role, text, before in rows:
        body, code = text.rstrip(SPACE), "x"
        if not body:
            blank += 1
        elif before or (role, text) in seen:
            twice += 1
        else:
            code = _initial(role)
            if body[-1] not in ".!?":
                cut, code = cut + 1, code.upper()
        seen.add((role, text))
        codes.append(code)
    return "".join(codes), blank, twice, cut


def edited(rows, labels, state: int = 0) -> Iterator[tuple]:
    """(label, role, text) of each edit; role is None where a row goes."""
    at = 0
    for label in labels:
        role, text = (None, "") if label == "I" else rows[at][1:3]
        at += label != "I"
        if label == "D":
            yield label, None, None
            continue
        if label == "K":
            state = KEEPS[state, _initial(role)]
        else:
            role, state = ADDS[state]
        yield label, role, text


def illegal(rows) -> int:
    return sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))


def gaps(turns) -> int:
    return max(turns) - min(turns) + 1 - len(turns) if turns else 0


def whole(rows) -> tuple[tuple, list]:
    """The report of a conversation whose rows are at hand, and its edits."""
    codes, blank, twice, cut = faults(rows)
    cost, labels, state = solve(codes)[0]
    edits = list(edited(rows, labels + list(ENDS[state])))
    text = "\n".join(f"{role}:{text}" for _, role, text in edits if role is not None)
    return (gaps({r[0] for r in rows if r[0] is not None}), blank, twice, cut, illegal(rows), cost,
            "".join(e[0] for e in edits), hashlib.sha256(text.encode()).hexdigest()), edits


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROW = "_c string, _conv {0}, _part int, _seq long, turn long, role string, text string, _alive boolean"
EDIT = "_c string, _conv {0}, _part int, _seq long, edit string, role string, text string"
CHUNK = ("_c string, _conv {0}, _part int, costs array<long>, ranks array<int>, n long, turns long, lo long, hi long, "
         "first string, last string, blank long, duplicate long, truncated long, illegal long")
LINK = ("_c string, _conv {0}, _part int, entry int, exit int, ends boolean, gaps long, blank long, duplicate long, "
        "truncated long, illegal long, cost long")


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def ordered(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, alive=None) -> DataFrame:
    """Rows dealt by range of their conversation's order and sorted. The last
    key splits equal rows, which may stand in either order."""
    spark = df.sparkSession
    conv = F.col(conv_col)
    rows = df.select(
        F.coalesce(F.concat(F.lit("0"), conv.cast("string")), F.lit("1")).alias("_c"), conv.alias("_conv"),
        F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        (F.lit(True) if alive is None else F.col(alive)).alias("_alive"),
        F.xxhash64(F.monotonically_increasing_id()).alias("_salt"))
    key = ["_c", F.col("turn").asc_nulls_first(), "role", "text", "_salt"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, *key).sortWithinPartitions(*key).drop("_salt")


def _solve_inside(rows: DataFrame, conv_type: str, edits: bool) -> DataFrame:
    """Reports (or edits) of the conversations inside a range, and the rows of
    those at its borders, told apart by ``_border``."""
    row_ddl, out_ddl = ROW.format(conv_type), EDIT.format(conv_type) if edits else f"_c string, _conv {conv_type}, {REPORT}"
    ddl = f"_border struct<{row_ddl}>, _done struct<{out_ddl}>"
    schemas = [_arrow(rows.sparkSession, d) for d in (row_ddl, out_ddl, ddl)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row_schema, out_schema, schema = schemas
        part, held, key, first = TaskContext.get().partitionId(), [], None, True
        done, border = [], []

        def out():
            a, b = _table(row_schema, border), _table(out_schema, done)
            pad = lambda t, before, after: pa.concat_arrays([
                pa.nulls(before, t), *got.chunks, pa.nulls(after, t)])
            cols = []
            for f, got, before, after in ((schema.field(0), a.to_struct_array(), 0, len(done)),
                                          (schema.field(1), b.to_struct_array(), len(border), 0)):
                cols.append(pad(f.type, before, after))
            n = len(border) + len(done)
            border.clear()
            done.clear()
            return pa.RecordBatch.from_arrays(cols, schema=schema) if n else None

        def finish(last: bool):
            if first or last:
                border.extend((key[0], key[1], part, seq, *r) for seq, r in enumerate(held))
                return
            report, steps = whole([(*r[:3], False) for r in held if r[3]])
            if edits:
                done.extend((*key, part, seq, *e) for seq, e in enumerate(steps))
            else:
                done.append((*key, *report))

        for batch in batches:
            for c, conv, *row in zip(*[col.to_pylist() for col in batch.columns]):
                if key is None or c != key[0]:
                    if key is not None:
                        finish(False)
                        first = False
                    key, held = (c, conv), []
                held.append(row)
            if (got := out()) is not None:
                yield got
        if key is not None:
            finish(True)
            if (got := out()) is not None:
                yield got

    return rows.mapInArrow(run, ddl)


def _chunk_stage(costs, ranks) -> tuple:
    """A chunk as one stage: arcs from entry to exit, labelled by rank."""
    return tuple(tuple((ranks[4 * s + e], costs[4 * s + e], 1, e) for e in range(4) if costs[4 * s + e] is not None)
                 for s in range(4))


def _one_exit(e: int) -> tuple:
    return tuple(0 if k == e else None for k in range(4))


def _rows_of(got: pa.Table) -> list[dict]:
    return sorted(got.to_pylist(), key=lambda r: (r["_part"], r.get("_seq", 0)))


def _summarise(schema: pa.Schema):
    """A chunk's costs and exit ranks by (entry, exit), and its counts."""
    def run(got: pa.Table) -> pa.Table:
        every = _rows_of(got)
        rows = [(r["turn"], r["role"], r["text"], r["_before"]) for r in every if r["_alive"]]
        codes, blank, twice, cut = faults(rows)
        by_exit = [solve(codes, _one_exit(e)) for e in range(4)]
        costs, ranks = [], []
        for s in range(4):
            paths = sorted("".join(x[s][1]) for x in by_exit if x[s])
            costs += [x[s][0] if x[s] else None for x in by_exit]
            ranks += [paths.index("".join(x[s][1])) if x[s] else None for x in by_exit]
        turns = {r[0] for r in rows if r[0] is not None}
        head = every[0]
        return _table(schema, [(
            head["_c"], head["_conv"], head["_part"], costs, ranks, len(rows), len(turns), min(turns, default=None),
            max(turns, default=None), rows[0][1][:1] if rows else None, rows[-1][1][:1] if rows else None, blank, twice,
            cut, illegal(rows))])
    return run


def _link(schema: pa.Schema):
    """Entry and exit of every chunk of a conversation, with its counts."""
    def run(got: pa.Table) -> pa.Table:
        parts = _rows_of(got)
        stages = [_chunk_stage(p["costs"], p["ranks"]) for p in parts]
        cost, labels, _ = solve(stages)[0]
        state, walked = 0, []
        for stage, label in zip(stages, labels):
            to = next(e for x, _, _, e in stage[state] if x == label)
            walked.append((state, to))
            state = to
        full = [p for p in parts if p["n"]]
        dated = [p for p in full if p["turns"]]
        shared = sum(a["hi"] == b["lo"] for a, b in zip(dated, dated[1:]))  # rows lie in order of turn
        n_turns = sum(p["turns"] for p in dated) - shared
        gap = dated[-1]["hi"] - dated[0]["lo"] + 1 - n_turns if dated else 0
        total = lambda c: sum(p[c] for p in parts)
        bad = total("illegal") + sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(full, full[1:]))
        return _table(schema, [(p["_c"], p["_conv"], p["_part"], *w, p is parts[-1], gap, total("blank"),
                                total("duplicate"), total("truncated"), bad, cost) for p, w in zip(parts, walked)])
    return run


def _write_edits(schema: pa.Schema):
    """The edits of a chunk whose entry and exit are known."""
    def run(got: pa.Table) -> pa.Table:
        every = _rows_of(got)
        rows = [(r["turn"], r["role"], r["text"], r["_before"]) for r in every if r["_alive"]]
        head = every[0]
        _, labels, state = solve(faults(rows)[0], _one_exit(head["exit"]))[head["entry"]]
        if head["ends"]:
            labels = labels + list(ENDS[state])
        return _table(schema, [(head["_c"], head["_conv"], head["_part"], seq, *e)
                               for seq, e in enumerate(edited(rows, labels, head["entry"]))])
    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of each conversation in a sorted stream of edits."""
    def out():
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array(["".join(audit)]), pa.array([sha.hexdigest()])],
                                          names=["_c", "audit", "repaired_sha256"])

    key = None
    for batch in batches:
        for c, edit, role, text in zip(*[col.to_pylist() for col in batch.columns]):
            if c != key:
                if key is not None:
                    yield out()
                key, audit, sha, begun = c, [], hashlib.sha256(), False
            audit.append(edit)
            if role is not None:
                sha.update(f"{chr(10) * begun}{role}:{text}".encode())
                begun = True
    if key is not None:
        yield out()


def _solve_border(rows: DataFrame, conv_type: str) -> tuple[DataFrame, DataFrame]:
    """Links and edits of the conversations whose rows lie at borders."""
    spark = rows.sparkSession
    chunk, link, edit = (x.format(conv_type) for x in (CHUNK, LINK, EDIT))
    said = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    rows = rows.withColumn("_said", said)
    firsts = rows.where("_alive").groupBy("_c", "_said").agg(F.min("_part").alias("_first"))
    rows = materialize(rows.join(firsts, ["_c", "_said"], "left").withColumn(
        "_before", F.coalesce(F.col("_first") < F.col("_part"), F.lit(False))).drop("_said", "_first"), "border")
    chunks = rows.groupBy("_c", "_part").applyInArrow(_summarise(_arrow(spark, chunk)), chunk)
    links = materialize(chunks.groupBy("_c").applyInArrow(_link(_arrow(spark, link)), link), "links")
    edits = rows.join(links.select("_c", "_part", "entry", "exit", "ends"), ["_c", "_part"]).groupBy(
        "_c", "_part").applyInArrow(_write_edits(_arrow(spark, edit)), edit)
    return links, edits


def _conv_type(df: DataFrame, conv_col: str) -> str:
    return df.schema[conv_col].dataType.simpleString()


def _run(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, alive, edits: bool):
    kind = _conv_type(df, conv_col)
    got = materialize(_solve_inside(ordered(df, conv_col, turn_col, role_col, text_col, alive), kind, edits), "inside")
    links, at_border = _solve_border(got.where("_border is not null").select("_border.*"), kind)
    return got.where("_done is not null").select("_done.*"), links, at_border


def repair_report(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", alive: str | None = None) -> DataFrame:
    """A row per conversation: faults found, the repair's cost, its edits'
    initials and the hash of the repaired turns. Rows whose ``alive`` column is
    false are gone, but their conversation is reported."""
    inside, links, edits = _run(df, conv_col, turn_col, role_col, text_col, alive, False)
    digests = edits.select("_c", "_part", "_seq", "edit", "role", "text").repartition("_c").sortWithinPartitions(
        "_c", "_part", "_seq").select("_c", "edit", "role", "text").mapInArrow(
        _digest, "_c string, audit string, repaired_sha256 string")
    border = links.where("ends").join(digests, "_c", "left").withColumn("audit", F.coalesce("audit", F.lit(""))).withColumn(
        "repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))
    cols = [F.col("_conv").alias(conv_col), *[c.split()[0] for c in REPORT.split(", ")]]
    return inside.select(*cols).unionByName(border.select(*cols))


def repaired_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """The repaired conversations: ``conv, _part, _seq`` (order of the turns),
    ``edit, role, text``; deleted rows are not returned."""
    inside, _, edits = _run(df, conv_col, turn_col, role_col, text_col, None, True)
    return inside.unionByName(edits).where("edit <> 'D'").drop("_c").withColumnRenamed("_conv", conv_col)


def damaged(df: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, _alive``: rows damaged by the checksum of
    ``conv_id:turn``; a dropped row stays with ``_alive`` false."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return df.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"),
        F.when(kind == 0, "").otherwise(text).alias("text"), (kind != 0).alias("_alive"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")).drop("_copy")


def _oracle() -> str:
    """The same repair in DuckDB: least (cost, initials) by state, row by row."""
    crc = []
    for b in range(256):
        for _ in range(8):
            b = b >> 1 ^ 0xEDB88320 * (b & 1)
        crc.append(b)
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    return f"""
WITH RECURSIVE
c AS (SELECT DISTINCT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS LAST) AS cid FROM conversations),
k AS (SELECT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS LAST) AS cid, turn, coalesce(role, ' ') AS role,
             coalesce(text, ' ') AS text,
             xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode({key})), '..'),
               lambda h: ('0x' || h)::BIGINT),
               lambda c, b: xor(c >> 8, ({crc}::BIGINT[])[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) % 20 AS kind
      FROM conversations),
d AS (SELECT cid, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM k WHERE kind <> 0),
o AS (SELECT cid, turn, role, text, row_number() OVER w AS i,
             lag(substr(role, 1, 1)) OVER w || substr(role, 1, 1) AS pair,
             NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
             regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) NOT IN ('.', '!', '?') AS cut
      FROM d WINDOW w AS (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text)),
r AS (SELECT *, blank OR again AS gone, NOT blank AND NOT again AND cut AS short FROM (
  SELECT *, row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 AS again FROM o)),
ins(s, s2, letters, price, lines) AS (VALUES
  (0, 0, '', 0, []::VARCHAR[]), (0, 2, 'I', 2, ['user:']), (0, 3, 'II', 4, ['user:', 'assistant:']), (1, 1, '', 0, []),
  (1, 2, 'I', 2, ['user:']), (1, 3, 'II', 4, ['user:', 'assistant:']), (2, 2, '', 0, []), (2, 3, 'I', 2, ['assistant:']),
  (3, 3, '', 0, []), (3, 2, 'I', 2, ['user:'])),
op(letter, s, s2, initial, new_role, price) AS (
  SELECT 'D', s, s, NULL::VARCHAR, NULL::VARCHAR, 3 FROM (VALUES (0), (1), (2), (3)) x(s)
  UNION ALL SELECT 'K', s, s2, initial, NULL::VARCHAR, 0 FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2))
    y(s, initial, s2)
  UNION ALL SELECT 'R', s, s2, NULL::VARCHAR, new_role, 2 FROM (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'),
    (3, 2, 'user')) z(s, s2, new_role)),
p AS (
  SELECT cid, 0::BIGINT AS i, 0 AS s, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS best FROM c
  UNION ALL
  SELECT p.cid, r.i, op.s2, min({{
    'cost': best.cost + ins.price + op.price + CASE WHEN letter <> 'D' AND short THEN 1 ELSE 0 END,
    'audit': best.audit || ins.letters || letter,
    'lines': best.lines || ins.lines || CASE WHEN letter = 'D' THEN [] ELSE [coalesce(new_role, role) || ':' || text] END}})
  FROM p JOIN r ON r.cid = p.cid AND r.i = p.i + 1 JOIN ins ON ins.s = p.s JOIN op ON op.s = ins.s2
  WHERE letter = 'D' OR (NOT gone AND (letter = 'R' OR substr(role, 1, 1) = initial))
  GROUP BY p.cid, r.i, op.s2),
n AS (SELECT cid, max(i) AS n FROM r GROUP BY cid),
e AS (SELECT p.cid, min({{'cost': best.cost + ins.price, 'audit': best.audit || ins.letters, 'lines': best.lines || ins.lines}})
        AS best FROM p LEFT JOIN n USING (cid) JOIN ins ON ins.s = p.s
      WHERE p.i = coalesce(n, 0) AND ins.s2 IN (0, 3) GROUP BY p.cid),
t AS (SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
             count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (short) AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY cid)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, best.cost::BIGINT AS cost, best.audit AS audit,
       sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM c JOIN e USING (cid) LEFT JOIN t USING (cid)
"""


@register("op11_turn_repair", _oracle())
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damaged(table(spark, sf_dir, "conversations")), alive="_alive")
