"""A scikit-learn-like regression pipeline over DataFrames: scaler (fitted on
the training rows only) → optional k-best feature selection → model.

Fitted state is small: scaler parameters and selected names live on the
driver, and so do boosted trees (bounded by their parameters); a KNN model's
training set stays a DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.operators import features as FE
from lathe.operators.knn import knn_join, knn_regress
from lathe.operators.boost import booster_column, booster_of, booster_table, fit_booster
from lathe.operators.models import booster_params, fit_group_mean, predict_group_mean

BOOSTERS = ("xgboost", "lightgbm")


@dataclass
class RegressionPipeline:
    features: list[str]
    target: str
    scaler: str | None = "robust"
    k_best: int | None = None
    model: str = "knn"  # knn | group_mean | xgboost | lightgbm
    model_params: dict = field(default_factory=dict)
    # fitted state
    scaler_params: dict | None = None
    selected: list[str] | None = None
    train_set: DataFrame | None = None
    fitted: object = None
    version: int | None = None  # of a model loaded from the registry

    # -------------------------------------------------------------- fit
    def fit(self, train: DataFrame, id_col: str) -> "RegressionPipeline":
        feats = list(self.features)
        df = train
        if self.scaler:
            self.scaler_params = FE.fit_scaler(df, feats, self.scaler)
            df = FE.apply_scaler(df, self.scaler_params)
        self.selected = FE.select_k_best(df.dropna(subset=feats + [self.target]), feats, self.target,
                                         self.k_best) if self.k_best else feats
        if self.model == "knn":
            self.train_set = df.select(F.col(id_col).alias("pid"), *self.selected, self.target)
        elif self.model == "group_mean":
            self.fitted = fit_group_mean(df, self.model_params["key"], self.target)
        elif self.model in BOOSTERS:
            self.fitted = fit_booster(df, self.selected, self.target, booster_params(self.model, **self.model_params), [id_col])
        else:
            raise ValueError(f"unknown model {self.model}")
        return self

    # -------------------------------------------------------------- predict
    def transform_features(self, df: DataFrame) -> DataFrame:
        return FE.apply_scaler(df, self.scaler_params) if self.scaler_params else df

    def search(self) -> tuple:
        """What a KNN model's neighbours depend on besides its training rows."""
        scaled = {k: dict(v) if isinstance(v, dict) else v for k, v in (self.scaler_params or {}).items()}
        return (repr(scaled), tuple(self.selected), self.target, int(self.model_params.get("n_neighbors", 5)),
                int(self.model_params.get("p", 2)))

    def neighbours(self, df: DataFrame, id_col: str) -> DataFrame:
        """``_qid, distance`` and the target of each row's nearest training rows."""
        *_, k, p = self.search()
        q = self.transform_features(df).select(F.col(id_col).alias("_qid"), *self.selected)
        nb = knn_join(q, self.train_set, self.selected, k=k, p=p, qid="_qid", pid="pid", payload=[self.target])
        return nb.select("_qid", "distance", self.target)

    def predict(self, df: DataFrame, id_col: str, out: str = "prediction",
                neighbours: DataFrame | None = None) -> DataFrame:
        """``neighbours``: those of ``df``, where a model with the same training
        rows and ``search`` has found them already."""
        if self.model == "knn":
            nb = self.neighbours(df, id_col) if neighbours is None else neighbours
            pred = knn_regress(nb, "_qid", self.target, self.model_params.get("weights", "uniform"), out)
            return df.join(pred.withColumnRenamed("_qid", id_col), id_col, "left")
        if self.model == "group_mean":
            return predict_group_mean(df, self.fitted, self.model_params["key"], out)
        if not self.scaler_params:
            return df.withColumn(out, self.column())
        kept = df.withColumns({f"_raw_{f}": F.col(f) for f in self.features})  # the rows keep their unscaled values
        return self.transform_features(kept).withColumn(out, self.column()).select(
            *[F.col(f"_raw_{c}").alias(c) if c in self.features else F.col(c) for c in df.columns if c != out], out)

    def column(self) -> Column:
        """A boosted model as a column expression over its (scaled) features:
        the same plan for batch and stream, without Python."""
        if self.model not in BOOSTERS:
            raise ValueError(f"{self.model} is no column expression")
        return booster_column(self.fitted)


def save_pipeline(spark, pipe: RegressionPipeline, root: str, name: str, version: int | None = None) -> str:
    """Persist a fitted pipeline as a registry version (None: the next): scaler parameters, KNN
    training set or trees as Parquet, the ordered feature list and settings as
    metadata."""
    from lathe.operators.models import save_model

    tables = {}
    if pipe.scaler_params:
        rows = [(c, float(pipe.scaler_params["center"][c]), float(pipe.scaler_params["scale"][c]))
                for c in pipe.scaler_params["center"]]
        tables["scaler"] = spark.createDataFrame(rows, "feature string, center double, scale double")
    if pipe.train_set is not None:
        tables["train_set"] = pipe.train_set
    if pipe.model == "group_mean":
        tables["group_means"] = pipe.fitted
    if pipe.model in BOOSTERS:
        tables["trees"] = booster_table(spark, pipe.fitted)
    params = {"target": pipe.target, "scaler": pipe.scaler, "k_best": pipe.k_best, "model": pipe.model,
              "model_params": pipe.model_params, "selected": pipe.selected, "all_features": pipe.features,
              "scaler_kind": pipe.scaler_params["kind"] if pipe.scaler_params else None}
    return save_model(spark, root, name, version, pipe.model, pipe.selected, tables, params)


def load_pipeline(spark, root: str, uri_or_name: str, version=None) -> RegressionPipeline:
    from lathe.operators.models import load_model

    meta = load_model(spark, root, uri_or_name, version)
    prm = meta["params"]
    pipe = RegressionPipeline(prm["all_features"], prm["target"], prm["scaler"], prm["k_best"], prm["model"],
                              prm["model_params"])
    pipe.selected, pipe.version = prm["selected"], meta["version"]
    if "scaler" in meta["tables"]:
        rows = meta["tables"]["scaler"].collect()  # two numbers per feature
        pipe.scaler_params = {"kind": prm["scaler_kind"], "center": {r["feature"]: r["center"] for r in rows},
                              "scale": {r["feature"]: r["scale"] for r in rows}}
        order = prm["all_features"]
        pipe.scaler_params["center"] = {c: pipe.scaler_params["center"][c] for c in order}
        pipe.scaler_params["scale"] = {c: pipe.scaler_params["scale"][c] for c in order}
    pipe.train_set = meta["tables"].get("train_set")
    if pipe.model == "group_mean":
        pipe.fitted = meta["tables"]["group_means"]
    elif pipe.model in BOOSTERS:
        pipe.fitted = booster_of(meta["tables"]["trees"], pipe.selected, pipe.model_params)
    return pipe


# The three ready pipelines (scaler, k-best, model, parameters).
PRESETS = {
    "knn": {"scaler": "robust", "k_best": None, "model": "knn", "model_params": {"n_neighbors": 5, "weights": "uniform"}},
    "xgboost": {"scaler": None, "k_best": None, "model": "xgboost", "model_params": {}},
    "lightgbm": {"scaler": None, "k_best": None, "model": "lightgbm", "model_params": {}},
}


def preset(name: str, features: list[str], target: str, **overrides) -> RegressionPipeline:
    """A ready pipeline by name; ``overrides`` are applied last."""
    if name not in PRESETS:
        raise ValueError(f"unknown preset {name}; choose from {sorted(PRESETS)}")
    cfg = dict(PRESETS[name])
    cfg["model_params"] = dict(cfg["model_params"])
    for k, v in overrides.items():
        if k in cfg:
            cfg[k] = v
        else:
            cfg["model_params"][k] = v
    return RegressionPipeline(features, target, **cfg)
