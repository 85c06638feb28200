"""Delay models: training, evaluation, artefacts, scoring of flights and scenarios."""

import math
from dataclasses import dataclass, replace
from functools import reduce
from typing import Optional, Union

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F

from delaylens import schemas as S
from delaylens.functions import columns as C
from delaylens.operators import boosting, graph, joins, quantiles, reports, reshape, risk
from delaylens.operators.boosting import Boosted
from delaylens.plans import fact as fact_plan
from delaylens.session import cut, shared_dir, stored
from delaylens.sources.tables import export_centrality, export_scores, table_exists

CLASSIFIERS = {"Logistic Regression": "logistic", "Random Forest": "forest",
               "Gradient Boosting": "boosted"}


@dataclass(frozen=True)
class Settings:
    """Model sizes of the scoring job; the study adds a minimum leaf size of 20.

    With ``histogram``, boosting is ``operators.boosting`` instead of MLlib's and stops early when the
    loss on held-back rows has not fallen for ``patience`` rounds. ``fit_rows`` bounds the rows that a
    model learns from (a hash sample; None: all); all are scored.
    """
    logistic_iterations: int = 1000
    forest_trees: int = 200
    forest_depth: int = 15
    boosted_rounds: int = 200
    boosted_depth: int = 5
    boosted_rate: float = 0.1
    histogram: bool = False
    patience: int = 10
    min_leaf: int = 1
    fit_rows: Optional[int] = None
    seed: int = 42
    features: tuple = tuple(S.FEATURE_COLUMNS)


def with_target(df: DataFrame) -> DataFrame:
    return df.withColumn("is_delayed", C.is_delayed("dep_delay_minutes"))


def feature_frame(fact: DataFrame, centrality: DataFrame, sample_pct=100) -> DataFrame:
    """Operated flights with all features and the target."""
    return with_target(joins.add_centrality(fact_plan.model_input(fact, sample_pct), centrality))


def assembler(features=S.FEATURE_COLUMNS, out="features"):
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def _filled(df, features):
    return df.fillna(0, [f for f in features if f in df.columns])


def _weighted(df):
    """Rows with the balanced class weight; one weight row per class is broadcast.

    The weights are cut from the rows: a fit goes over these many times, and would count them each time.
    """
    weights = cut(risk.class_weights(df).select("is_delayed", "weight"))
    return df.join(F.broadcast(weights), "is_delayed")


def stages(kind, cfg: Settings):
    if kind == "logistic":
        return [assembler(cfg.features, "raw"),
                StandardScaler(inputCol="raw", outputCol="features", withMean=True),
                LogisticRegression(labelCol="is_delayed", weightCol="weight",
                                   maxIter=cfg.logistic_iterations)]
    if kind == "forest":
        return [assembler(cfg.features), RandomForestClassifier(
            labelCol="is_delayed", weightCol="weight", numTrees=cfg.forest_trees,
            maxDepth=cfg.forest_depth, minInstancesPerNode=cfg.min_leaf, seed=cfg.seed)]
    boosted = dict(maxIter=cfg.boosted_rounds, maxDepth=cfg.boosted_depth,
                   stepSize=cfg.boosted_rate, minInstancesPerNode=cfg.min_leaf, seed=cfg.seed,
                   cacheNodeIds=True, checkpointInterval=10)
    if kind == "boosted":
        return [assembler(cfg.features), GBTClassifier(labelCol="is_delayed", **boosted)]
    if kind == "minutes":
        return [assembler(cfg.features), GBTRegressor(labelCol="dep_delay_minutes", **boosted)]
    raise ValueError(f"unknown model kind {kind!r}")


#: Target and loss of the boosted models.
BOOSTED = {"boosted": ("is_delayed", "logistic"), "minutes": ("dep_delay_minutes", "squared")}

Model = Union[PipelineModel, Boosted]


def learnt_rows(df: DataFrame, cfg: Settings) -> DataFrame:
    """All rows, or about ``fit_rows`` of them by a hash of their values."""
    n = df.count() if cfg.fit_rows else 0
    if n <= (cfg.fit_rows or 0):
        return df
    draw = F.pmod(F.xxhash64(*cfg.features, "is_delayed", "dep_delay_minutes"), F.lit(n))
    return df.where(draw < cfg.fit_rows)


def learnt_table(df: DataFrame, cfg: Settings) -> DataFrame:
    """``learnt_rows`` for several models: a sample is written once, with the columns they learn from.

    It is dealt to every core, or to more parts so that one has no more rows than a page of boosting;
    their number follows ``fit_rows``, not the parts of the table that the sample is drawn from.
    """
    rows = learnt_rows(df, cfg)
    if not cfg.fit_rows:
        return rows
    narrow = rows.select(*[f for f in cfg.features if f in rows.columns], "is_delayed", "dep_delay_minutes")
    parts = max(df.sparkSession.sparkContext.defaultParallelism,
                math.ceil(cfg.fit_rows / boosting.PAGE_ROWS))
    return stored(narrow.repartition(parts), "learnt")


def train(df: DataFrame, kind, cfg: Settings = Settings()) -> Model:
    """Fit one model on a frame with the features, ``is_delayed`` and minutes."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    ready = _filled(learnt_rows(df, cfg), cfg.features)
    if kind in BOOSTED and cfg.histogram:
        target, loss = BOOSTED[kind]
        return boosting.fit(ready, cfg.features, target, loss, cfg.boosted_rounds, cfg.boosted_depth,
                            cfg.boosted_rate, cfg.min_leaf, patience=cfg.patience)
    if kind in ("logistic", "forest"):
        ready = _weighted(ready)
    return Pipeline(stages=stages(kind, cfg)).fit(ready)


def predict(df: DataFrame, model: Model, features=S.FEATURE_COLUMNS) -> DataFrame:
    """Add ``risk_score`` and ``prediction``."""
    ready = _filled(df, features)
    if isinstance(model, Boosted):
        return model.predict(ready, "risk_score").withColumn(
            "prediction", F.when(F.col("risk_score") > 0.5, 1.0).otherwise(0.0))
    return model.transform(ready).withColumn(
        "risk_score", vector_to_array("probability")[1]).drop(
        "features", "raw", "rawPrediction", "probability")


def predict_minutes(df: DataFrame, model: Model, features=S.FEATURE_COLUMNS) -> DataFrame:
    ready = _filled(df, features)
    if isinstance(model, Boosted):
        return model.predict(ready, "predicted_minutes")
    return model.transform(ready).drop("features").withColumnRenamed("prediction", "predicted_minutes")


def score_flights(df: DataFrame, model: Model) -> DataFrame:
    """Score every row, training rows included; ``split`` stays when it is there."""
    scored = with_target(predict(df, model)).withColumn("risk_label", C.risk_label("risk_score"))
    return reshape.select_existing(scored, [*S.SCORE_COLUMNS, "split"])


def compare(models: dict, test: DataFrame) -> DataFrame:
    """One metric row per named model; ``best`` marks the highest AUC."""
    rows = [risk.binary_metrics(predict(test, m)).withColumn("model", F.lit(name))
            for name, m in models.items()]
    table = reduce(DataFrame.unionByName, rows)
    table = cut(table)  # one row per model
    best = table.agg(F.max_by("model", "auc")).scalar()
    return table.withColumn("best", F.col("model") == best).select(
        "model", "accuracy", "f1", "auc", "best")


def importance(spark, model: Model, features=S.FEATURE_COLUMNS) -> DataFrame:
    """(feature, importance, label), highest first; absolute weights for linear models."""
    if isinstance(model, Boosted):
        values = model.importance()
    else:
        last = model.stages[-1]
        values = (last.featureImportances if hasattr(last, "featureImportances")
                  else last.coefficients).toArray()
    rows = [(f, abs(float(v)), S.FEATURE_LABELS.get(f, f)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double, label string").orderBy(
        F.desc("importance"), "feature")


def weather_importance(table: DataFrame) -> DataFrame:
    """The weather features alone, with the label that the flag has among them."""
    label = F.when(F.col("feature") == S.WEATHER_FLAG, S.WEATHER_FLAG_LABEL).otherwise(F.col("label"))
    return table.where(F.col("feature").isin(S.WEATHER_FEATURES)).withColumn("label", label)


# --- artefacts ---------------------------------------------------------------------

@dataclass
class Artifacts:
    model: Model
    features: list
    medians: DataFrame
    regressor: Optional[Model] = None


def save_model(model: Model, spark, path) -> None:
    if isinstance(model, Boosted):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)


def load_model(spark, path) -> Model:
    return (PipelineModel.load(path) if table_exists(spark, f"{path}/metadata")
            else Boosted.load(spark, path))


def save_artifacts(path, spark, models: dict, medians: DataFrame,
                   features=S.FEATURE_COLUMNS) -> None:
    for kind, model in models.items():
        save_model(model, spark, f"{path}/{kind}")
    names = spark.createDataFrame(list(enumerate(features)), "position int, feature string")
    names.write.mode("overwrite").parquet(f"{path}/features")
    medians.write.mode("overwrite").parquet(f"{path}/medians")


def load_artifacts(path, spark) -> Optional[Artifacts]:
    """The boosted model with its features and medians, or None when a piece is missing."""
    if not all(table_exists(spark, f"{path}/{p}") for p in ("boosted", "features", "medians")):
        return None
    named = spark.read.parquet(f"{path}/features").orderBy("position").collect()
    regressor = (load_model(spark, f"{path}/minutes")
                 if table_exists(spark, f"{path}/minutes") else None)
    return Artifacts(load_model(spark, f"{path}/boosted"), [r["feature"] for r in named],
                     spark.read.parquet(f"{path}/medians"), regressor)


# --- scenarios -----------------------------------------------------------------------

def score_scenarios(scenarios: DataFrame, art: Artifacts, centrality: DataFrame,
                    coords: DataFrame) -> DataFrame:
    """Probability, band and expected minutes for rows of partial inputs."""
    full = risk.complete_features(scenarios, art.medians, centrality, coords, art.features)
    scored = predict(full, art.model, art.features).drop("prediction")
    if art.regressor is not None:
        scored = predict_minutes(scored, art.regressor, art.features)
    return scored.withColumn("band", C.risk_band("risk_score"))


# --- the whole job ---------------------------------------------------------------------

def report_tables(scored: DataFrame) -> dict:
    """Tables behind the printed report."""
    return {
        "by_airline": reports.report_rates(scored, "airline_code", 1000, 15),
        "by_hour": reports.group_mean(scored, "scheduled_dep_hour", "is_delayed"),
        "score_histogram": reports.histogram(scored, "risk_score", 0.0, 1.0, 60),
        "by_origin": reports.report_rates(scored, "Origin", 500, 20),
        "by_month": reports.monthly_score_trend(scored),
    }


def run_training(fact: DataFrame, cfg: Settings = Settings(), sample_pct=100, k=100,
                 out: Optional[str] = None, edges: Optional[DataFrame] = None) -> dict:
    """Network, features, models, scores and report tables from a fact table.

    The feature frame is written to the shared folder once, and so are the rows
    that the models learn from when ``fit_rows`` bounds them; nothing but model
    parameters and metric rows reaches the driver. The network is that of the
    flown flights unless ``edges`` gives another.
    """
    spark = fact.sparkSession
    flown = fact.where(F.col("is_cancelled") == F.lit(False))
    if edges is None:
        edges = graph.network(flown, "origin_airport_id", "dest_airport_id")
    # as a table its size is known, so the joins can decide to broadcast it
    centrality = stored(graph.centrality_scores(edges, k), "centrality")
    frame = feature_frame(fact, centrality, sample_pct)
    split = stored(risk.stratified_split(frame, "is_delayed", "flight_id"), "features")
    fit, test = split.where("split = 'train'"), split.where("split = 'test'")

    learnt, whole = learnt_table(fit, cfg), replace(cfg, fit_rows=None)
    models = {name: train(learnt, kind, whole) for name, kind in CLASSIFIERS.items()}
    minutes = train(learnt, "minutes", whole)
    scored = score_flights(split, models["Gradient Boosting"])
    medians = quantiles.medians(_filled(split, cfg.features), list(cfg.features))
    if out:
        export_scores(scored, f"{out}/risk_scores")
        export_centrality(centrality, f"{out}/centrality_metrics")
        kinds = {CLASSIFIERS[n]: m for n, m in models.items()}
        save_artifacts(f"{out}/models", spark, {**kinds, "minutes": minutes}, medians,
                       list(cfg.features))
    return {
        "centrality": centrality, "comparison": compare(models, test), "scored": scored,
        "mae": risk.mean_absolute_error(
            predict_minutes(test, minutes), "dep_delay_minutes", "predicted_minutes"),
        "medians": medians, "importance": importance(spark, models["Gradient Boosting"],
                                                     cfg.features),
        "models": {**models, "minutes": minutes}, **report_tables(scored),
    }
