"""Document fingerprints by winnowing, on DataFrame functions only.

Tokens are runs of non-space characters; a run longer than ``PIECE`` is cut
after every border character (about one in eight) and otherwise after
``PIECE`` characters, so that text without spaces has tokens too and the cuts
after an inserted character fall back on the old ones at the next border.
Every ``K`` consecutive tokens hash
to one value (rolling: each position combines the hashes of the tokens there).
From every window of ``W`` consecutive k-grams the smallest hash is chosen,
the rightmost on ties, with its position. Guarantee: two texts that share a
run of ``W + K - 1`` tokens share a fingerprint hash.

A k-gram is packed as ``hash31 << 32 | (2^32 - 1 - position)``: the smallest
packed value of a window is its smallest hash, rightmost on ties, and carries
the position.

Defined results: a null text counts as empty; a text without tokens has the
empty fingerprint; one with fewer than ``K`` tokens has a single gram, one
with fewer than ``W`` grams a single window. Likeness is the Jaccard index of
the distinct hashes; two empty fingerprints are alike (1.0). Rows with the
same id share one place in the order: their next document is the smallest
text of the next larger id (after the last the first; a null id comes first);
repeated rows give repeated results. With one document it is its own next.
Other input columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import let, neighbours, table, text_or_empty
from lathe.llm.registry import register

K = 4
W = 8
PIECE = 16
_LOW = (1 << 32) - 1
_RUN = r"[^\x20\x09-\x0D]"


def _borders() -> str:
    """Character class of the border characters: an eighth of the code points,
    in narrow strips in small alphabets and wide ones in large."""
    strips = [(a, a) for a in range(0x27, 0x80, 8)]
    for first, end, step in ((0x80, 0x1000, 32), (0x1000, 0x3000, 128), (0x3000, 0x3100, 32), (0x3200, 0xD800, 512),
                             (0xE000, 0x10000, 512), (0x10000, 0x40000, 4096)):
        strips += [(a, a + step // 8 - 1) for a in range(first, end, step)]
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in strips) + "]"


# a whole short run, or a piece of a long one up to a border or PIECE characters
TOKEN = (rf"(?<!{_RUN}){_RUN}{{1,{PIECE}}}+(?!{_RUN})"
         rf"|(?={_RUN})(?:{_RUN}{{0,{PIECE - 1}}}?{_borders()}|{_RUN}{{1,{PIECE}}})")  # no border is tried at a space


def token_hashes(text: Column) -> Column:
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _grams(h: Column, k: int) -> Column:
    """Packed k-grams; fewer than k tokens give one gram of all of them."""
    n = F.greatest(F.size(h) - (k - 1), F.least(F.size(h), F.lit(1)))
    return F.transform(F.slice(h, F.lit(1), n), lambda x, i: F.shiftleft(
        F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]).bitwiseAND(F.lit(0x7FFFFFFF)), 32) + (F.lit(_LOW) - i))


def _window_minima(g: Column, w: int) -> Column:
    """Smallest value of every window of ``w`` (by doubling; a last step
    overlaps where ``w`` is no power of two)."""
    def widen(m: Column, have: int) -> Column:
        if have == w:
            n = F.greatest(F.size(m) - (w - 1), F.least(F.size(m), F.lit(1)))
            return F.slice(m, F.lit(1), n)
        step = min(have, w - have)
        return let(F.transform(m, lambda x, i: F.least(x, F.get(m, i + step))), lambda n: widen(n, have + step))

    return widen(g, 1)


def fingerprint(text: Column, k: int = K, w: int = W) -> Column:
    """Array of packed (hash, position), in text order."""
    return let(token_hashes(text), lambda h: let(
        _grams(h, k), lambda g: F.array_distinct(_window_minima(g, w))))


def hashes(fp: Column) -> Column:
    return F.array_distinct(F.transform(fp, lambda x: F.shiftright(x, 32).cast("int")))


def positions(fp: Column) -> Column:
    return F.transform(fp, lambda x: F.lit(_LOW) - x.bitwiseAND(F.lit(_LOW)))


def as_text(fp: Column) -> Column:
    """``hash@position`` in hex and decimal, space-separated."""
    return F.array_join(F.transform(fp, lambda x: F.concat(
        F.lower(F.hex(F.shiftright(x, 32))), F.lit("@"), (F.lit(_LOW) - x.bitwiseAND(F.lit(_LOW))).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    return let(both, lambda n: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(
        n / (F.size(a) + F.size(b) - n)))


def fingerprints_with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text (the last quarter of its
    code points replaced by as many from the next document), and likenesses.

    One shuffle moves the texts with their fingerprints to their id and serves
    both uses of them (the same exchange is read twice); a second moves, to
    the previous id, the prefix its edit needs and the hashes. The join key is
    text without nulls, so the join, the grouping and the second join share
    one partitioning."""
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))
    d = df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    ids = d.groupBy("_id").agg(F.max(F.floor(F.length("_text") / 4)).alias("need"))
    near = neighbours(ids, "_id", "need").select(key("_id").alias("_at"), key("prev_key").alias("_prev"), "prev_need")
    full = d.select(key("_id").alias("_key"), "_id", "_text", fingerprint(F.col("_text")).alias("_fp"))
    placed = full.join(near.hint("merge"), F.col("_key") == F.col("_at"))
    nxt = (placed.groupBy("_key").agg(F.min(F.struct("_text", "_fp", "_id")).alias("_least"),
                                      F.first("_prev").alias("_for"), F.first("prev_need").alias("_need"))
           .select("_for", F.substring(F.col("_least._text"), F.lit(1), F.col("_need").cast("int")).alias("_head"),
                   hashes(F.col("_least._fp")).alias("_next_hashes")))
    both = full.join(nxt.hint("merge"), F.col("_key") == F.col("_for"), "left")
    n = F.length("_text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - cut),
                      F.substring(F.col("_head"), F.lit(1), cut))
    both = both.withColumn("_edited", edited).withColumn("_mine", hashes(F.col("_fp")))
    both = both.withColumn("_efp", fingerprint(F.col("_edited")))
    return both.select(
        F.col("_id").alias(id_col), n.cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"),
        as_text(F.col("_fp")).alias("fingerprint"), as_text(F.col("_efp")).alias("edited_fingerprint"),
        likeness(F.col("_mine"), hashes(F.col("_efp"))).alias("near_edited"),
        likeness(F.col("_mine"), F.col("_next_hashes")).alias("near_next"))


@register("op6_winnowing")
def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints_with_edits(table(spark, sf_dir, "documents"))
