"""Recommender and regression models, their comparison, and the run log."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.base import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.complete import complete_rows
from starledger.operators.metrics import regression_metrics
from starledger.operators.sampling import hash_sample, hash_split
from starledger.plans.boosting import fit_boosted
from starledger.plans.features import NUMERIC_FEATURES
from starledger.plans.forest import fit_forest
from starledger.schemas import COMPARISON_SCHEMA, IMPORTANCE_SCHEMA, RUN_LOG_SCHEMA
from starledger.session import workspace

PAIR = ["user_id", "item_id"]
PUBLISHED_PREDICTIONS = 5_000
#: Tasks of ALS on either side. Factors start at random per block, so another number of
#: blocks gives another model; it follows from nothing but this setting.
ALS_BLOCKS = 10
#: Rounds after which ALS checkpoints its factors. It then drops the messages of the rounds before,
#: which else lie on the executors' disks for as long as the model is used.
ALS_CHECKPOINT = 3

# The models compared, and their settings.
REGRESSORS: dict[str, tuple[type[Estimator], dict[str, object]]] = {
    "Linear Regression": (LinearRegression, {"maxIter": 50, "regParam": 0.1}),
    "Decision Tree Regressor": (DecisionTreeRegressor, {"maxDepth": 8, "seed": 42}),
    "Random Forest Regressor": (RandomForestRegressor, {"numTrees": 50, "maxDepth": 8, "seed": 42}),
    "GBT Regressor": (GBTRegressor, {"maxIter": 50, "maxDepth": 5, "seed": 42}),
    "Generalized Linear Regression": (
        GeneralizedLinearRegression,
        {"family": "gaussian", "link": "identity", "maxIter": 50, "regParam": 0.1},
    ),
}
SINGLE_TREE, FOREST, BOOSTED = "Decision Tree Regressor", "Random Forest Regressor", "GBT Regressor"
TREE_MODELS = [SINGLE_TREE, FOREST, BOOSTED]
#: Training rows beyond which forests and boosted trees grow from binned rows. Below, the jobs of
#: the many passes cost more than their rows, and MLlib's own passes are as good.
BINNED_ROWS = 2_000_000
ALS_SETTINGS: dict[str, object] = {"rank": 10, "maxIter": 10, "regParam": 0.1}


def fit_als(
    train: DataFrame,
    settings: Mapping[str, object] = ALS_SETTINGS,
    seed: int = 42,
    blocks: int = ALS_BLOCKS,
) -> ALSModel:
    """Non-negative ALS; users or items unseen in training get no prediction.

    ALS runs one task per block: raise ``blocks`` for more ratings, and keep it to get the
    same model again. The workspace gives ALS a checkpoint folder, where it cuts its
    lineage every third round.
    """
    workspace(train.sparkSession)
    als = ALS(
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=ALS_CHECKPOINT,
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        nonnegative=True,
        coldStartStrategy="drop",
        seed=seed,
        **settings,
    )
    return als.fit(train)


def labelled(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows of the feature table, label and vector only."""
    rows = complete_rows(features.select(*PAIR, "title", F.col("rating").alias("label"), "features"))
    return hash_split(rows, PAIR)


def like_together(rows: DataFrame) -> DataFrame:
    """``rows`` in an order, within each partition, that puts rows of like features together.

    Trees send such rows the same way. The nodes they pass and the counters they add to are then
    still in the processor's cache; a forest's deepest level alone has tens of megabytes of
    counters. Means go by quarters, so that the second one orders rows too. The keys are columns,
    as a sort evaluates its expressions at every comparison.
    """
    slots = vector_to_array("features")
    user, item = (slots[NUMERIC_FEATURES.index(f"{side}_avg_rating")] for side in ("user", "item"))
    keyed = rows.withColumns({"_user": F.round(user * 4), "_item": F.round(item * 4), "_mean": user})
    return keyed.sortWithinPartitions("_user", "_item", "_mean").drop("_user", "_item", "_mean")


def fit_regressor(train: DataFrame, name: str, settings: Mapping[str, object] | None = None) -> Model:
    """Fit one of ``REGRESSORS``; ``settings`` replace its own one by one."""
    kind, own = REGRESSORS[name]
    workspace(train.sparkSession)
    estimator = kind(featuresCol="features", labelCol="label", predictionCol="prediction", **{**own, **(settings or {})})
    if name in (FOREST, BOOSTED) and train.count() > BINNED_ROWS:
        return fit_forest(train, estimator) if name == FOREST else fit_boosted(train, estimator)
    return estimator.fit(train)


def depth_of(name: str) -> int:
    """The greatest depth of a tree model's trees."""
    return int(REGRESSORS[name][1]["maxDepth"])


def trees_count_alike(name: str) -> bool:
    """Whether all trees of a model count alike, or each by the error it takes away."""
    return name != BOOSTED


def predictions_of(model: Model, test: DataFrame, name: str) -> DataFrame:
    """Predictions, residuals and the model's name."""
    scored = model.transform(test)
    return scored.select(
        *PAIR, "title", F.col("label").alias("actual_rating"), F.col("prediction").alias("predicted_rating")
    ).withColumns(
        {"residual": F.col("actual_rating") - F.col("predicted_rating"), "model_name": F.lit(name)}
    )


@dataclass(frozen=True)
class Trained:
    """A fitted model with its test metrics."""

    name: str
    model: Model
    metrics: dict[str, float]


def train_regressor(
    train: DataFrame, test: DataFrame, name: str, settings: Mapping[str, object] | None = None
) -> Trained:
    model = fit_regressor(train, name, settings)
    metrics = regression_metrics(predictions_of(model, test, name), "actual_rating", "predicted_rating").first()
    return Trained(name, model, metrics.asDict())


def training_place() -> Column:
    """The place of ``model_name`` among ``REGRESSORS``, which settles ties of the rmse."""
    return F.array_position(F.array(*[F.lit(name) for name in REGRESSORS]), F.col("model_name"))


def comparison_table(spark: SparkSession, trained: list[Trained]) -> DataFrame:
    """One row per model, least rmse first."""
    rows = [(t.name, t.metrics["rmse"], t.metrics["mae"], t.metrics["r2"]) for t in trained]
    return spark.createDataFrame(rows, COMPARISON_SCHEMA).orderBy("rmse", training_place(), "model_name")


def importance_table(spark: SparkSession, trained: list[Trained], slots: list[str]) -> DataFrame:
    """Importance of every vector slot in every tree model, under the slot's name."""
    rows = [
        (t.name, slot, float(weight))
        for t in trained
        if hasattr(t.model, "featureImportances")
        for slot, weight in zip(slots, t.model.featureImportances.toArray(), strict=True)
    ]
    return spark.createDataFrame(rows, IMPORTANCE_SCHEMA).orderBy(
        "model_name", F.desc("importance"), "feature_name"
    )


def best_of(trained: list[Trained]) -> Trained:
    """Least rmse; the first trained wins a tie."""
    return min(trained, key=lambda t: t.metrics["rmse"])


def published_predictions(trained: list[Trained], test: DataFrame, n: int = PUBLISHED_PREDICTIONS) -> DataFrame:
    """A fixed sample of the best model's predictions."""
    best = best_of(trained)
    return hash_sample(predictions_of(best.model, test, best.name), PAIR, n)


def run_record(
    spark: SparkSession,
    run_name: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    artifact: str | None = None,
) -> DataFrame:
    """One run as rows (run, kind, key, value), to append to the run log."""
    run_id = uuid.uuid4().hex
    rows = [(run_id, run_name, "param", k, str(v)) for k, v in params.items()]
    rows += [(run_id, run_name, "metric", k, repr(float(v))) for k, v in metrics.items()]
    if artifact:
        rows.append((run_id, run_name, "artifact", "model", artifact))
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1)


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)
