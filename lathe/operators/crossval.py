"""Cross-validation without a driver loop over folds.

For additive models (group means) every fold's training fit comes from one
aggregate: per (fold, key) sums, then "total minus own fold". Scoring
expands each row to its k (model-fold, role) pairs — a fixed factor k, not a
pairwise product — and one grouped metric aggregate yields train and test
scores for every fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.operators.evaluate import regression_metrics
from lathe.operators.split import kfold
from lathe.session import bounded_broadcast


def cv_group_mean(df: DataFrame, id_cols: list[str], key: str, target: str, k: int = 5, seed: int = 42,
                  max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Long scores ``fold, metric, score`` with scikit-learn scorer names
    (``{train,test}_neg_mean_absolute_error``, ``…_neg_mean_squared_error``,
    ``…_r2``). Keys unseen in a fold's training part fall back to that
    fold's training mean."""
    folded = kfold(df.select(*id_cols, key, target), id_cols, k, seed)
    per = folded.groupBy("fold", key).agg(F.sum(target).alias("s"), F.count(F.lit(1)).alias("c"))
    folds = F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    tot = per.groupBy(key).agg(F.sum("s").alias("ts"), F.sum("c").alias("tc"))
    grid = tot.select(key, "ts", "tc", folds.alias("model_fold"))
    own = per.select(F.col("fold").alias("model_fold"), key, "s", "c")
    # null-safe: rows with a NULL key are a group of their own, in every fold
    own = own.withColumnsRenamed({"model_fold": "_of", key: "_ok"})
    model = (grid.join(own, (F.col("model_fold") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_ok")), "left")
             .select("model_fold", key, (F.col("ts") - F.coalesce("s", F.lit(0.0))).alias("ms"),
                     (F.col("tc") - F.coalesce("c", F.lit(0))).alias("mc")))
    glob = model.groupBy("model_fold").agg(F.try_divide(F.sum("ms"), F.sum("mc")).alias("gp"))
    model = (model.join(glob, "model_fold")
             .select("model_fold", key, F.coalesce(F.try_divide("ms", "mc"), F.col("gp")).alias("mp")))
    model = bounded_broadcast(model, max_broadcast_rows)
    expanded = folded.select(key, target, "fold", folds.alias("model_fold")).withColumn(
        "part", F.when(F.col("fold") == F.col("model_fold"), F.lit("test")).otherwise(F.lit("train")))
    model = model.withColumnsRenamed({"model_fold": "_of", key: "_ok"})
    scored = expanded.join(model, (F.col("model_fold") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_ok")), "inner")
    m = regression_metrics(scored, target, "mp", by=["model_fold", "part"])
    return m.select(F.col("model_fold").alias("fold"), F.explode(F.array(
        F.struct(F.concat(F.col("part"), F.lit("_neg_mean_absolute_error")).alias("metric"), (-F.col("mae")).alias("score")),
        F.struct(F.concat(F.col("part"), F.lit("_neg_mean_squared_error")).alias("metric"), (-F.col("mse")).alias("score")),
        F.struct(F.concat(F.col("part"), F.lit("_r2")).alias("metric"), F.col("r2").alias("score")),
    )).alias("s")).select("fold", "s.metric", "s.score")
