"""Quality classifier with hierarchical empirical Bayes over sites.

Evidence: a logistic regression on surface features of the whole text
(computed by Spark expressions), fitted on at most ``SAMPLE`` labelled rows
chosen by hash. Its log odds minus the log odds of the labels' base rate are
the document's own evidence.

Site prior: the classifier's probabilities are summed by path (host and
language) and by host. A host's rate is shrunk toward the global rate and a
path's rate toward its host's, each as a Beta posterior mean
(good + kappa * prior) / (n + kappa); kappa is estimated by moments from how
much the rates of sites really differ (sparse sites move little, alike sites
not at all). The document's own probability is left out of its site's sums.

Posterior log odds = evidence + log odds of the path's rate; a document is
rejected below ``KEEP``.

All statistics are grouped aggregations with map-side partial sums over
narrow rows; hot hosts meet as partial sums only, and rows find their site by
a join that carries no text.

Defined results: a null or empty text has all features 0; null hosts or
languages are sites of their own; repeated rows count each; without labels of
both classes the evidence is 0 and every document has the global rate 0.5 and
stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import ascii_lower, let, row_key, table, text_or_empty
from lathe.llm.registry import register
from lathe.session import materialize

SAMPLE = 20_000
KEEP = 0.5
RIDGE = 1.0
FEATURES = ["upper", "digit", "punct", "symbol", "bang", "pipe", "new_words", "new_runs", "new_lines", "word_len",
            "size", "new_words_by_size"]


def _share(text: Column, chars: str, of: Column) -> Column:
    """Characters of the text that are in the class, per ``of``."""
    return (F.length(text) - F.length(F.regexp_replace(text, chars, ""))) / of


def features(text: Column) -> Column:
    """Array of FEATURES; all 0 for an empty text."""
    def of_words(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))
        chars = F.greatest(F.length(text), F.lit(1))
        runs = F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 3, F.lit(1))), lambda w, i: F.xxhash64(
            w, F.get(words, i + 1), F.get(words, i + 2), F.get(words, i + 3)))
        lines = F.split(text, "\n")
        distinct = F.size(F.array_distinct(words)) / n
        size = F.log(n.cast("double"))
        return F.array(
            _share(text, r"[A-Z]", chars), _share(text, r"[0-9]", chars), _share(text, r"[!-/:-@\[-`{-~]", chars),
            _share(text, r"[%&*#$@^~]", chars), F.least(_share(text, "!", n), F.lit(2.0)),
            F.least(_share(text, r"\|", n), F.lit(2.0)), distinct,
            let(runs, lambda r: F.size(F.array_distinct(r)) / F.greatest(F.size(r), F.lit(1))),
            F.size(F.array_distinct(lines)) / F.size(lines), F.least(chars / n, F.lit(30.0)), size, distinct * size)

    words = F.transform(F.regexp_extract_all(ascii_lower(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)),
                        lambda w: F.xxhash64(w))
    return F.when(F.length(text) > 0, let(words, of_words)).otherwise(F.array(*[F.lit(0.0)] * len(FEATURES)))


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weights, intercept and base rate of a ridge logistic regression by
    Newton steps on scaled features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.diag([RIDGE] * x.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return np.column_stack([mean, scale, w[:-1]]), float(w[-1]), float(y.mean())


def trained(rows: DataFrame, labels: DataFrame, id_col: str) -> tuple | None:
    """Fit on a hash-chosen sample of ``SAMPLE`` labels; at most twice as many
    feature rows (ids may repeat) reach the driver."""
    known = (labels.where("quality is not null").select(F.col("doc_id").alias("_label_id"), F.col("quality").alias("_y"))
             .orderBy(F.xxhash64("_label_id"), "_label_id", "_y").limit(SAMPLE))
    # SAMPLE narrow rows are broadcast, so no text moves; features are computed where the texts lie
    got = (rows.join(F.broadcast(known), F.col(id_col) == F.col("_label_id"))
           .select(features(F.col("_text")).alias("x"), "_y").limit(2 * SAMPLE).toPandas())
    if got["_y"].nunique() < 2:
        return None
    return fit(np.array(got["x"].tolist()), got["_y"].to_numpy(float))


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(0.01)), F.lit(0.99))
    return F.log(q / (1 - q))


def _kappa(rates: DataFrame, good: str, n: str) -> float:
    """Beta concentration of rates around their mean, by moments."""
    got = rates.agg(F.sum(good), F.sum(n), F.count(F.lit(1)), F.sum(F.col(good) * F.col(good) / F.col(n))).first()
    if not got[1]:
        return 1.0
    mean, total, sites = got[0] / got[1], got[1], got[2]
    spread = got[3] / total - mean * mean - mean * (1 - mean) * sites / total
    return float(min(max(mean * (1 - mean) / max(spread, 1e-6) - 1, 1.0), 1e6))


def scored(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
           path_col: str = "lang") -> DataFrame:
    """``_row`` (hash of id, text and site), ``_id, evidence, site_rate, posterior,
    kept`` per row."""
    rows = df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"), F.col(host_col).alias("_host"),
                     F.col(path_col).alias("_path"))
    model = trained(rows, labels, "_id")
    if model is None:
        evidence, base = F.lit(0.0), 0.5
    else:
        parts, bias, base = model
        evidence = let(features(F.col("_text")), lambda x: sum(
            (F.least(F.greatest((F.get(x, F.lit(i)) - float(m)) / float(s), F.lit(-8.0)), F.lit(8.0)) * float(w)
             for i, (m, s, w) in enumerate(parts)), F.lit(bias - float(np.log(base / (1 - base))))))
    prior = float(np.log(base / (1 - base)))
    seen = materialize(rows.select("_id", row_key("_id", "_text", "_host", "_path").alias("_row"), "_host", "_path",
                                   evidence.alias("evidence"))
                       .withColumn("_p", 1 / (1 + F.exp(-(F.col("evidence") + prior)))), "evidence")
    paths = materialize(seen.groupBy("_host", "_path").agg(F.sum("_p").alias("_pg"), F.count(F.lit(1)).alias("_pn")),
                        "paths")
    hosts = materialize(paths.groupBy(F.col("_host").alias("_h")).agg(F.sum("_pg").alias("_hg"),
                                                                      F.sum("_pn").alias("_hn")), "hosts")
    total = hosts.agg(F.sum("_hg"), F.sum("_hn")).first()
    overall = total[0] / total[1] if total[1] else 0.5
    k_host, k_path = _kappa(hosts, "_hg", "_hn"), _kappa(paths, "_pg", "_pn")
    sites = paths.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).select(
        F.col("_host").alias("_sh"), F.col("_path").alias("_sp"), "_pg", "_pn", "_hg", "_hn")
    got = seen.join(sites, F.col("_host").eqNullSafe(F.col("_sh")) & F.col("_path").eqNullSafe(F.col("_sp")))
    host = (F.col("_hg") - F.col("_p") + k_host * overall) / (F.col("_hn") - 1 + k_host)
    rate = (F.col("_pg") - F.col("_p") + k_path * host) / (F.col("_pn") - 1 + k_path)
    got = got.withColumn("site_rate", rate)
    odds = F.col("evidence") + _logit(F.col("site_rate"))
    got = got.withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return got.select("_row", "_id", "evidence", "site_rate", "posterior", (F.col("posterior") >= KEEP).alias("kept"))


def accepted(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
             path_col: str = "lang") -> DataFrame:
    """The rows of ``df`` that the classifier keeps, with all their columns."""
    kept = scored(df, labels, id_col, text_col, host_col, path_col).where("kept").select(
        F.col("_row").alias("_quality_key")).distinct()
    row = row_key(id_col, text_or_empty(text_col), host_col, path_col)
    return df.join(kept, row == F.col("_quality_key"), "left_semi")


@register("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select(F.col("_id").alias("doc_id"), "evidence", "site_rate", "posterior", "kept")
