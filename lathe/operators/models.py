"""Models: a group-mean baseline, presets of the gradient-boosted trees, and
model persistence in a versioned registry folder."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.operators.boost import BoostParams
from lathe.session import bounded_broadcast


# ---------------------------------------------------------------- group mean
def fit_group_mean(df: DataFrame, key: str | list[str], target: str) -> DataFrame:
    """Mean target per key plus a global-mean row (key NULL, ``_global``
    true) used for keys unseen in training. One aggregate with partial
    aggregation (a hot key costs one partial row per task); the fitted table
    (one row per key) is materialised once with ``checkpoint()``."""
    from lathe.session import work_dir

    keys = [key] if isinstance(key, str) else list(key or [])
    per_key = df.groupBy(*keys).agg(F.sum(target).alias("_s"), F.count(target).alias("_c"))
    work_dir(df.sparkSession)
    per_key = per_key.checkpoint()
    glob = per_key.agg(F.try_divide(F.sum("_s"), F.sum("_c")).alias("prediction")).select(
        *[F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys], "prediction", F.lit(True).alias("_global"))
    per_key = per_key.select(*keys, F.try_divide("_s", "_c").alias("prediction"), F.lit(False).alias("_global"))
    return per_key.unionByName(glob)


def predict_group_mean(df: DataFrame, model: DataFrame, key: str | list[str], out: str = "prediction",
                       max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Per-key mean, falling back to the global mean (a fitted scalar, used
    as a literal) for keys absent from the model."""
    keys = [key] if isinstance(key, str) else list(key or [])
    g = model.filter(F.col("_global")).select("prediction").first()
    gp = F.lit(g["prediction"] if g else None).cast("double")
    if not keys:  # global mean model: a literal, no join
        return df.withColumn(out, gp)
    per_key = model.filter(~F.col("_global")).select(*[F.col(k).alias(f"_m_{k}") for k in keys],
                                                    F.col("prediction").alias("_kp"))
    per_key = bounded_broadcast(per_key, max_broadcast_rows, materialize=False)
    cond = None
    for k in keys:
        c = df[k] == per_key[f"_m_{k}"]
        cond = c if cond is None else cond & c
    return (df.join(per_key, cond, "left")
            .withColumn(out, F.coalesce(F.col("_kp"), gp))
            .drop("_kp", *[f"_m_{k}" for k in keys]))


# ---------------------------------------------------------------- boosted trees
# The tuned booster parameters.
BOOSTER_PRESETS = {
    "xgboost": {"n_estimators": 50, "max_depth": 6, "learning_rate": 0.2, "subsample": 1.0, "colsample_bytree": 0.9,
                "reg_alpha": 0.1, "reg_lambda": 1.0},
    "lightgbm": {"n_estimators": 50, "max_depth": 9, "learning_rate": 0.1, "subsample": 0.9, "colsample_bytree": 0.8,
                 "reg_alpha": 1.0, "reg_lambda": 1.5, "num_leaves": 31},
}
# What each kind sets where its parameters do not. The leaf-wise
# kind draws rows only if told how often, and wants 20 rows a leaf.
BOOSTER_KINDS = {
    "xgboost": {"min_child_rows": 1, "subsample_freq": 1, "max_bins": 256},
    "lightgbm": {"min_child_rows": 20, "subsample_freq": 0, "max_bins": 255, "num_leaves": 31},
}


def booster_params(kind: str, **overrides) -> BoostParams:
    """The tuned parameters of ``kind`` with ``overrides``; ``random_state``
    is the seed. Unknown names raise."""
    given = {**BOOSTER_KINDS[kind], **BOOSTER_PRESETS[kind], **overrides}
    if "random_state" in given:
        given["seed"] = given.pop("random_state")
    return BoostParams(**given)


# ---------------------------------------------------------------- registry
def claim_version(spark: SparkSession, root: str, name: str) -> int:
    """The next free version of ``name``, for this caller alone: an empty file
    named by the number is created under ``root/name/_versions``, which only
    one of several writers can do. A number whose save fails later is not
    given out again. The file system must create files exclusively (local
    folders and HDFS do; an object store must offer conditional writes)."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    claims = jvm.org.apache.hadoop.fs.Path(folder, "_versions")
    fs.mkdirs(claims)
    names = [f.getPath().getName() for at in (folder, claims) for f in fs.listStatus(at)]
    taken = [int(n.removeprefix("version=")) for n in names if n.removeprefix("version=").isdigit()]
    version = max(taken, default=0) + 1
    while not _created(jvm, fs, jvm.org.apache.hadoop.fs.Path(claims, str(version))):
        version += 1
    return version


def _created(jvm, fs, path) -> bool:
    """Whether this call created the file; False where it was there."""
    try:
        if fs.getUri().getScheme() == "file":  # Hadoop's local file system checks first and creates then
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(path.toUri().getPath()).toPath(), _no_attributes(jvm))
        else:
            fs.create(path, False).close()
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def _no_attributes(jvm):
    return jvm.java.lang.reflect.Array.newInstance(
        jvm.java.lang.Class.forName("java.nio.file.attribute.FileAttribute"), 0)


def save_model(spark: SparkSession, root: str, name: str, version: int | None, model_type: str, features: list[str],
               tables: dict[str, DataFrame] | None = None, params: dict | None = None, mllib=None) -> str:
    """Write a model version to ``root/name/version=N``: parameter tables as
    Parquet, an MLlib pipeline with its own writer, and ``meta`` (ordered
    feature list, type, parameters) as a one-row JSON table, written last: a
    version is listed once it is whole. ``version`` None claims the next."""
    version = claim_version(spark, root, name) if version is None else version
    path = f"{root.rstrip('/')}/{name}/version={version}"
    for tname, t in (tables or {}).items():
        t.write.mode("overwrite").parquet(f"{path}/{tname}")
    if mllib is not None:
        mllib.write().overwrite().save(f"{path}/mllib")
    meta = {"name": name, "version": version, "model_type": model_type, "features": features,
            "params": params or {}, "tables": sorted((tables or {}).keys()), "mllib": mllib is not None}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")
    return path


def parse_model_uri(uri: str) -> tuple[str, str]:
    """``models:/name/version`` → (name, version); ``version`` may be
    ``latest``."""
    if not uri.startswith("models:/"):
        raise ValueError(f"not a model URI: {uri}")
    parts = uri[len("models:/"):].split("/")
    if len(parts) != 2 or not parts[0] or not parts[1]:
        raise ValueError(f"bad model URI: {uri}")
    return parts[0], parts[1]


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    """Every registered version: name, version, path (from the meta files)."""
    metas = spark.read.schema("meta string").json(f"{root.rstrip('/')}/*/version=*/meta")
    return metas.select(
        F.get_json_object("meta", "$.name").alias("name"),
        F.get_json_object("meta", "$.version").cast("int").alias("version"),
        F.get_json_object("meta", "$.model_type").alias("model_type"),
    )


def load_model(spark: SparkSession, root: str, uri_or_name: str, version: str | int | None = None) -> dict:
    """Load by ``models:/name/version`` URI or by name (+ version, default
    latest = highest version). Returns meta plus lazily-read tables."""
    if uri_or_name.startswith("models:/"):
        name, version = parse_model_uri(uri_or_name)
    else:
        name = uri_or_name
    if not name:
        raise ValueError("empty model name")
    if version in (None, "latest"):
        row = (list_versions(spark, root).filter(F.col("name") == name).agg(F.max("version").alias("v")).first())
        if row is None or row["v"] is None:
            raise ValueError(f"no versions of model {name}")
        version = row["v"]
    path = f"{root.rstrip('/')}/{name}/version={int(version)}"
    meta = json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()["meta"])
    meta["path"] = path
    meta["tables"] = {t: spark.read.parquet(f"{path}/{t}") for t in meta["tables"]}
    if meta.get("mllib"):
        from pyspark.ml import PipelineModel

        meta["mllib"] = PipelineModel.load(f"{path}/mllib")
    return meta
