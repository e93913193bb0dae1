"""License scans by diagonal voting, on DataFrame functions only.

Every pair of neighbouring words of a text (a rolling 2-gram) hashes to one
value; Spark joins these to the positions of the same pairs in the templates.
A match of text position p with template position q votes for the diagonal
p - q. An unaltered occurrence puts all its votes on one diagonal; inserted or
lost words move the rest of it to a neighbouring one, so diagonals at most
``GAP`` apart are merged. A merged span is verified: at least ``COVERAGE`` of
the template's pairs must occur in it, within ``STRETCH`` times the template's
length. The join compares the words themselves, so a hash collision casts no
vote, and a base phrase counts where one diagonal holds all its pairs, which
is exactly where its words stand consecutively.

Templates are a parameter: (label, text, base) with 2 to 63 words. Their pairs
are the broadcast side, bounded by 62 per template.

Defined results: a null text counts as empty: 0 words, no labels, score 0; a
text of one word has no pair; rows with the same id and text give the same
result each; a null id is kept; an empty table gives an empty result; other
input columns are ignored. ``score`` is the largest share of a template's
pairs in a verified span, 0 without one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import ascii_lower, table, text_or_empty
from lathe.llm.registry import register
from lathe.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = 2
COVERAGE = 0.75
STRETCH = 1.5

# Base phrases and their labels.
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]
# Sentences of public licenses by which a notice is known.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
TEMPLATES = [(label, text, True) for label, text in BASE] + [(label, text, False) for label, text in NOTICES]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def template_pairs(spark: SparkSession, templates) -> DataFrame:
    rows = []
    for t, (label, text, base) in enumerate(templates):
        words = text.split()
        if not 2 <= len(words) <= 63:
            raise ValueError(f"template needs 2 to 63 words: {text}")
        rows += [(t, label, base, len(words) - 1, q, a, b) for q, (a, b) in enumerate(zip(words, words[1:]))]
    df = spark.createDataFrame(rows, "tmpl int, label string, base boolean, pairs int, q int, wa string, wb string")
    return df.withColumn("tgram", F.xxhash64("wa", "wb"))


def votes(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """A row per text (``_id, _h``), template and diagonal: the template
    positions seen (``mask``, a bit each) and the first and last text position."""
    pairs = template_pairs(docs.sparkSession, templates)
    words = docs.select("_id", F.xxhash64("_text").alias("_h"), words_of(F.col("_text")).alias("_words"))
    grams = F.transform(F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 1, F.lit(0))),
                        lambda w, i: F.xxhash64(w, F.get("_words", i + 1)))
    # outer: without it Catalyst adds a filter that computes the array twice
    rolled = words.select("_id", "_h", "_words", F.posexplode_outer(grams).alias("_p", "_gram"))
    met = rolled.join(F.broadcast(pairs), (F.col("_gram") == F.col("tgram")) & (F.get("_words", F.col("_p")) == F.col("wa"))
                      & (F.get("_words", F.col("_p") + 1) == F.col("wb")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("q"))
    return met.groupBy("_id", "_h", "tmpl", "label", "base", "pairs", (F.col("_p") - F.col("q")).alias("diag")).agg(
        F.bit_or(bit).alias("mask"), F.min("_p").alias("first"), F.max("_p").alias("last"))


def spans(diagonals: DataFrame) -> DataFrame:
    """Neighbouring diagonals merged; verified spans only."""
    w = Window.partitionBy("_id", "_h", "tmpl").orderBy("diag")
    opened = F.when(F.col("diag") - F.lag("diag").over(w) <= GAP, 0).otherwise(1)
    merged = diagonals.withColumn("_new", opened).withColumn("_span", F.sum("_new").over(w))
    merged = merged.groupBy("_id", "_h", "tmpl", "label", "pairs", "_span").agg(
        F.bit_or("mask").alias("mask"), F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.withColumn("share", F.bit_count("mask") / F.col("pairs")).where(
        (F.col("share") >= COVERAGE) & (F.col("last") - F.col("first") + 2 <= STRETCH * (F.col("pairs") + 1)))


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """``id, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    docs = df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    found = materialize(votes(docs, templates), "votes")  # few rows, read twice
    base = F.col("base") & (F.bit_count("mask") == F.col("pairs"))
    verified = spans(found).select("_id", "_h", "label", "share", F.lit(False).alias("exact"), F.lit(None).alias("at"))
    exact = found.where(base).select("_id", "_h", "label", F.lit(1.0).alias("share"), F.lit(True).alias("exact"),
                                     F.col("first").alias("at"))
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731  at most one per template
    hits = exact.unionByName(verified).groupBy("_id", "_h").agg(
        F.count("at").alias("n_base"), F.min("at").alias("first_word"), F.max("at").alias("last_word"),
        labels(F.when(F.col("exact"), F.col("label"))).alias("base_labels"), labels(F.col("label")).alias("labels"),
        F.max("share").alias("score"))
    every = docs.select(F.col("_id").alias("_k"), F.xxhash64("_text").alias("_t"),
                        F.regexp_count(ascii_lower(F.col("_text")), F.lit(WORD)).cast("long").alias("n_words"))
    got = every.join(hits, F.col("_k").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_h")), "left")
    return got.select(
        F.col("_k").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.round(F.coalesce("score", F.lit(0.0)), 9).alias("score"))


def _oracle() -> str:
    """The same scan in DuckDB, on the words themselves."""
    values = ", ".join(f"({t}, '{label}', {base}, {len(ws) - 1}, {q}, '{a}', '{b}')"
                       for t, (label, text, base) in enumerate(TEMPLATES) for ws in [text.split()]
                       for q, (a, b) in enumerate(zip(ws, ws[1:])))
    return f"""
WITH t(tmpl, label, base, pairs, q, wa, wb) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM documents),
p AS (SELECT r, unnest(range(0, len(ws) - 1)) AS p, ws FROM d WHERE len(ws) > 1),
m AS (SELECT r, tmpl, label, base, pairs, p - q AS diag, q, p FROM p JOIN t ON ws[p + 1] = wa AND ws[p + 2] = wb),
g AS (SELECT r, tmpl, label, base, pairs, diag, list(DISTINCT q) AS qs, min(p) AS first, max(p) AS last FROM m
      GROUP BY ALL),
o AS (SELECT *, CASE WHEN diag - lag(diag) OVER (PARTITION BY r, tmpl ORDER BY diag) <= {GAP} THEN 0 ELSE 1 END AS new
      FROM g),
n AS (SELECT *, sum(new) OVER (PARTITION BY r, tmpl ORDER BY diag) AS span FROM o),
s AS (SELECT r, label, len(list_distinct(flatten(list(qs)))) / pairs AS share FROM n
      GROUP BY r, tmpl, label, pairs, span
      HAVING share >= {COVERAGE} AND max(last) - min(first) + 2 <= {STRETCH} * (pairs + 1)),
h AS (SELECT r, label, 1.0 AS share, first AS pos FROM g WHERE base AND len(qs) = pairs
      UNION ALL SELECT r, label, share, NULL FROM s),
a AS (SELECT r, count(pos) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
             array_to_string(list_sort(list(DISTINCT label) FILTER (pos IS NOT NULL)), ',') AS base_labels,
             array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score FROM h GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(coalesce(score, 0)::DOUBLE, 9) AS score
FROM d LEFT JOIN a USING (r)
"""


@register("op1_license_scan", _oracle())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
