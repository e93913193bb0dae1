"""Preference formatting of chat conversations.

A pair is a chosen and a rejected conversation. Their longest common prefix of
turns is rendered once as the prompt; the turns after it are rendered as the
chosen and the rejected completion. ``*_spans`` lists, as ``start-end`` in
characters of the completion, what a loss may see: the text and end mark of
assistant turns; everything else is masked.

The prefix ends before the first turn at which the sides differ: sides meet by
a join on (pair, turn) and the cut is a minimum per pair, so no task holds a
conversation for it. Output rows hold ``CHUNK`` turn numbers each: a long
conversation gives several rows (``chunk`` 0, 1, ...) whose parts concatenate
to the whole, and one row is the usual case.

The query pairs each conversation with itself, its last assistant turn
replaced by that of the next conversation (ascending id, the last followed by
the first) that has one: a fluent answer to another question.

Defined results: turns are ordered by number (null last); rows with the same
number stand in order of role and text; a null role or text is an empty
one; where sides are equal, everything is prompt and the completions are
empty; a conversation without an assistant turn is such a pair in the query; a
null id is a conversation; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import neighbours, table
from lathe.llm.registry import register

CHUNK = 64
LAST = (1 << 63) - 1  # position of a null turn number
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"


def _turns(df: DataFrame, pair: str) -> DataFrame:
    return df.select(F.col(pair).alias("_pair"), F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("_at"),
                     F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
                     .alias("_said"))


def _render(turns: Column) -> Column:
    """Text of an ordered array of turns."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE))), "")


def _spans(turns: Column) -> Column:
    """``start-end`` of what is trained, in the rendered text."""
    lead = len(OPEN) + 1

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + lead + F.length(t["role"])
        end = start + F.length(t["text"]) + len(CLOSE)
        span = F.array(F.concat(start.cast("string"), F.lit("-"), end.cast("string")))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.when(t["role"] == TRAINED, span).otherwise(
            F.array().cast("array<string>"))).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.array_join(F.aggregate(turns, zero, step, lambda acc: acc["out"]), ",")


def preference_pairs(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id") -> DataFrame:
    """``pair, chunk, prompt, chosen, rejected, chosen_spans, rejected_spans,
    prompt_turns`` from turns (pair, turn, role, text) of both sides."""
    side = lambda df, name: _turns(df, pair).groupBy("_pair", "_at").agg(
        F.sort_array(F.collect_list("_said")).alias(name))
    a, b = side(chosen, "_c"), side(rejected, "_r").withColumnsRenamed({"_pair": "_q", "_at": "_b"})
    both = a.join(b, F.col("_pair").eqNullSafe(F.col("_q")) & (F.col("_at") == F.col("_b")), "full").select(
        F.when(F.col("_c").isNotNull(), F.col("_pair")).otherwise(F.col("_q")).alias("_pair"),
        F.coalesce("_at", "_b").alias("_at"), "_c", "_r")
    cuts = both.groupBy(F.col("_pair").alias("_k")).agg(
        F.min(F.when(~F.col("_c").eqNullSafe(F.col("_r")), F.col("_at"))).alias("_cut"))
    both = both.join(cuts, F.col("_pair").eqNullSafe(F.col("_k")))
    shared = F.col("_cut").isNull() | (F.col("_at") < F.col("_cut"))
    parts = both.groupBy("_pair", F.floor(F.col("_at") / CHUNK).alias("chunk")).agg(*[
        F.flatten(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("_at", F.col(c).alias("t"))))),
                              lambda x: F.coalesce(x["t"], F.array().cast(both.schema["_c"].dataType)))).alias(name)
        for name, c, cond in (("p", "_c", shared), ("c", "_c", ~shared), ("r", "_r", ~shared))])
    return parts.select(
        F.col("_pair").alias(pair), F.col("chunk").cast("long"), _render(F.col("p")).alias("prompt"),
        _render(F.col("c")).alias("chosen"), _render(F.col("r")).alias("rejected"),
        _spans(F.col("c")).alias("chosen_spans"), _spans(F.col("r")).alias("rejected_spans"),
        F.size("p").cast("long").alias("prompt_turns"))


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Each conversation with its last assistant turn replaced by that of the
    next conversation that has one."""
    turns = conversations.select("conv_id", "turn", "role", "text")
    at = F.coalesce(F.col("turn").cast("long"), F.lit(LAST))
    last = turns.where(F.col("role") == TRAINED).groupBy("conv_id").agg(
        F.max(F.struct(at.alias("at"), F.coalesce("text", F.lit("")).alias("text"))).alias("_last"))
    order = neighbours(last.select("conv_id"), "conv_id").select(F.col("conv_id").alias("_own"), "next_key")
    donors = last.select(F.col("conv_id").alias("_from"), F.col("_last.text").alias("_given"))
    own = last.select("conv_id", "_last.at", F.col("_last.text").alias("_old"))
    swap = (order.join(donors, F.col("next_key").eqNullSafe(F.col("_from")))
            .join(own, F.col("_own").eqNullSafe(F.col("conv_id"))).select("_own", "at", "_old", "_given"))
    got = turns.join(swap, F.col("conv_id").eqNullSafe(F.col("_own")), "left")
    hit = (F.col("role") == TRAINED) & (at == F.col("at")) & (F.coalesce("text", F.lit("")) == F.col("_old"))
    return got.select("conv_id", "turn", "role", F.when(hit, F.col("_given")).otherwise(F.col("text")).alias("text"))


def _oracle() -> str:
    said = f"'{OPEN}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '{CLOSE.strip()}' || chr(10)"
    spans = (f"string_agg(CASE WHEN role = '{TRAINED}' THEN (start)::BIGINT || '-' || (start + length(coalesce(text, '')) +"
             f" {len(CLOSE)})::BIGINT END, ',' ORDER BY turn)")
    return f"""
WITH t AS (SELECT conv_id, turn, role, text FROM conversations),
l AS (SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text FROM t WHERE role = '{TRAINED}' GROUP BY conv_id),
n AS (SELECT conv_id, turn, coalesce(lead(text) OVER (ORDER BY conv_id), first_value(text) OVER (ORDER BY conv_id)) AS given
      FROM l),
r AS (SELECT t.conv_id, t.turn, role, CASE WHEN t.turn = n.turn THEN given ELSE text END AS text
      FROM t LEFT JOIN n ON t.conv_id = n.conv_id),
cut AS (SELECT t.conv_id, min(t.turn) FILTER (t.text IS DISTINCT FROM r.text) AS cut
        FROM t JOIN r ON t.conv_id = r.conv_id AND t.turn = r.turn GROUP BY t.conv_id),
s AS (SELECT side, x.conv_id, turn, role, text, cut IS NULL OR turn < cut AS shared, {said} AS said
      FROM (SELECT 'c' AS side, * FROM t UNION ALL SELECT 'r', * FROM r) x JOIN cut ON x.conv_id = cut.conv_id),
p AS (SELECT *, turn // {CHUNK} AS chunk, sum(length(said)) OVER (PARTITION BY side, conv_id, shared, turn // {CHUNK}
        ORDER BY turn) - length(said) + {len(OPEN) + 1} + length(coalesce(role, '')) AS start FROM s)
SELECT conv_id, chunk::BIGINT AS chunk, coalesce(string_agg(said, '' ORDER BY turn) FILTER (shared AND side = 'c'), '') AS prompt,
       coalesce(string_agg(said, '' ORDER BY turn) FILTER (NOT shared AND side = 'c'), '') AS chosen,
       coalesce(string_agg(said, '' ORDER BY turn) FILTER (NOT shared AND side = 'r'), '') AS rejected,
       coalesce({spans} FILTER (NOT shared AND side = 'c'), '') AS chosen_spans,
       coalesce({spans} FILTER (NOT shared AND side = 'r'), '') AS rejected_spans,
       count(*) FILTER (shared AND side = 'c') AS prompt_turns
FROM p GROUP BY conv_id, chunk
"""


@register("op5_preferences", _oracle())
def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return preference_pairs(turns.select("conv_id", "turn", "role", "text"), swapped_answers(turns), "conv_id")
