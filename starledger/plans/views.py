"""Views over published tables: what a dashboard shows.

Stored tables carry no order, so each view sorts for itself and breaks ties by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.operators.sampling import hash_sample
from starledger.plans.training import training_place

SCATTER_ROWS = 2_000


def top_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows of a total order."""
    return df.orderBy(*order).limit(n)


def most_rated_items(ranking: DataFrame, n: int = 15) -> DataFrame:
    return top_n(ranking, n, F.desc("rating_count"), "item_id")


def best_rated_items(ranking: DataFrame, min_ratings: int = 30, n: int = 15) -> DataFrame:
    enough = ranking.filter(F.col("rating_count") >= F.lit(min_ratings))
    return top_n(enough, n, F.desc("avg_rating"), F.desc("rating_count"), "item_id")


def most_active_users(activity: DataFrame, n: int = 15) -> DataFrame:
    return top_n(activity, n, F.desc("rating_count"), "user_id")


def tags_by_count(stats: DataFrame) -> DataFrame:
    return stats.orderBy(F.desc("rating_count"), "tag")


def tags_by_mean(stats: DataFrame) -> DataFrame:
    return stats.orderBy(F.desc("avg_rating"), "tag")


def best_model(comparison: DataFrame) -> DataFrame:
    """The model with the least rmse, the first trained on a tie; figures rounded for display."""
    best = top_n(comparison, 1, "rmse", training_place(), "model_name")
    return best.select("model_name", *[F.round(m, 4).alias(m) for m in ("rmse", "mae", "r2")])


def metrics_long(comparison: DataFrame, metrics: Sequence[str] = ("rmse", "mae", "r2")) -> DataFrame:
    """One row per model and metric."""
    return comparison.unpivot("model_name", list(metrics), "metric", "value")


def model_names(df: DataFrame) -> DataFrame:
    return df.select("model_name").distinct()


def importance_for_model(importances: DataFrame, model_name: str) -> DataFrame:
    chosen = importances.filter(F.col("model_name") == F.lit(model_name))
    return chosen.orderBy(F.desc("importance"), "feature_name")


def actual_vs_predicted(predictions: DataFrame, n: int = SCATTER_ROWS) -> DataFrame:
    """A fixed sample of predictions for a scatter plot; all of them when few."""
    sample = hash_sample(predictions, ["user_id", "item_id"], n)
    return sample.select("actual_rating", "predicted_rating", "user_id", "item_id", "title", "residual")


def predicted_vs_residual(predictions: DataFrame) -> DataFrame:
    return predictions.select("predicted_rating", "residual", "actual_rating", "title")
