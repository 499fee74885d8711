"""The recommender for ids of any size, and a proof that its fit is optimal."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.operators.joins import lookup_join
from starledger.operators.numbering import dense_ids
from starledger.plans.training import ALS_BLOCKS, ALS_SETTINGS, fit_als, save_model
from starledger.session import stage

#: MLlib's ids are signed 32-bit numbers.
LEAST_ID, MOST_ID = -(1 << 31), (1 << 31) - 1
#: What rounding of single-precision factors may leave of a gradient, as a share of its terms.
TOLERANCE = 1e-6


def fits_32_bits(ratings: DataFrame) -> bool:
    """Whether every user and item id can be given to MLlib as it is."""
    sides = ("user_id", "item_id")
    if not all(isinstance(ratings.schema[c].dataType, T.IntegralType) for c in sides):
        return False
    ends = ratings.agg(*[f(c) for c in sides for f in (F.min, F.max)]).first()
    return all(v is None or LEAST_ID <= v <= MOST_ID for v in ends)


@dataclass(frozen=True)
class Recommender:
    """A fitted model. ``users`` (user_id, user_number) and ``items`` (item_id, item_number)
    hold the numbers that the model knows the ids by; None where it knows the ids themselves."""

    model: ALSModel
    users: DataFrame | None = None
    items: DataFrame | None = None

    def numbered(self, ratings: DataFrame) -> DataFrame:
        """``ratings`` with ``user_number`` and ``item_number``; rows with an id that the
        model has not seen are left out."""
        if self.users is None:
            return ratings.withColumns({"user_number": F.col("user_id"), "item_number": F.col("item_id")})
        with_users = lookup_join(ratings, self.users, "user_id")
        return lookup_join(with_users, self.items, "item_id")

    def transform(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with ``prediction``; pairs with an unseen user or item are dropped."""
        model = self.model.copy({self.model.userCol: "user_number", self.model.itemCol: "item_number"})
        return model.transform(self.numbered(pairs)).select(*pairs.columns, "prediction")

    def save(self, path: str) -> None:
        """The model, and beside it the tables of numbers."""
        save_model(self.model, path)
        for name, table in (("users", self.users), ("items", self.items)):
            if table is not None:
                table.write.mode("overwrite").parquet(f"{path}-{name}")

    @staticmethod
    def load(spark: SparkSession, path: str, wide: bool) -> Recommender:
        """What ``save`` wrote; ``wide`` tells whether there are tables of numbers."""
        tables = [spark.read.parquet(f"{path}-{name}") for name in ("users", "items")] if wide else [None, None]
        return Recommender(ALSModel.load(path), *tables)


def fit_recommender(
    train: DataFrame, settings: Mapping[str, object] = ALS_SETTINGS, seed: int = 42, blocks: int = ALS_BLOCKS, wide: bool | None = None
) -> Recommender:
    """Non-negative ALS over ids of any type.

    Ids that MLlib cannot take are numbered densely in their own order, by ranges, and joined
    back after prediction; hot ids are sliced in these joins. ``wide`` asks for it or rules it
    out; by default the ids decide. Either side may have 2^31 ids.
    """
    if not (not fits_32_bits(train) if wide is None else wide):
        return Recommender(fit_als(train, settings, seed, blocks))
    users, items = dense_ids(train, "user_id", "user_number"), dense_ids(train, "item_id", "item_number")
    for table, side in ((users, "user_number"), (items, "item_number")):
        if (table.agg(F.max(side)).first()[0] or 0) > MOST_ID:
            raise ValueError(f"more than 2^31 ids for {side}")
    numbers = Recommender(None, users, items).numbered(train)
    rows = numbers.select(F.col("user_number").alias("user_id"), F.col("item_number").alias("item_id"), "rating")
    return Recommender(fit_als(stage(rows, "numbered-ratings"), settings, seed, blocks), users, items)


def optimality(
    recommender: Recommender, train: DataFrame, settings: Mapping[str, object] = ALS_SETTINGS, tolerance: float = TOLERANCE
) -> DataFrame:
    """(user_id, ratings, gap, optimal) per trained user: does its factor minimise its loss?

    The last step of ALS solves each user's factor x >= 0 from the item factors y. The loss,
    half the squared errors plus half of regParam * ratings * |x|^2, has the gradient

        g = sum(y (x . y - r)) + regParam * ratings * x

    and x is its minimum over x >= 0 exactly where g is zero for each positive component and
    not negative for each zero one. ``gap`` is the worst breach of that, as a share of the sum
    of the absolute terms of g; ``optimal`` tells whether it is within ``tolerance``.

    Ratings meet the item factors first, while they are narrow, then those of the users, so that
    a user's ratings are together when they are added up: the largest shuffle carries one factor
    per rating, in single precision as ALS has it, and the sums are one row per user and slice.
    Hot users and items are sliced.
    """
    rank, wide = recommender.model.rank, recommender.users is not None
    factors = {
        side: stage(own.select(F.col("id").alias(f"{side}_number"), F.col("features").alias(name)), f"{side}-factors")
        for side, own, name in (("user", recommender.model.userFactors, "x"), ("item", recommender.model.itemFactors, "y"))
    }
    keys = ["user_number", "user_id"] if wide else ["user_number"]
    rated = recommender.numbered(train.select("user_id", "item_id", F.col("rating").cast("float").alias("rating")))
    rated = rated.select(*keys, "item_number", "rating")
    # Every trained item has a factor, so that this join loses no rating.
    counts = rated.groupBy("user_number").agg(F.count(F.lit(1)).alias("n"))
    rated = lookup_join(rated, factors["item"], "item_number").drop("item_number")
    rated = lookup_join(rated, factors["user"], "user_number", key_counts=counts)
    x, y = ([F.col(name)[k].cast("double") for k in range(rank)] for name in "xy")
    rating = F.col("rating").cast("double")
    dot = sum((a * b for a, b in zip(x, y, strict=True)), F.lit(0.0))
    rated = rated.withColumns({"dot": dot, "error": dot - rating})
    sums = [F.sum(F.col("error") * y[k]).alias(f"g{k}") for k in range(rank)]
    terms = [F.sum(F.abs(y[k]) * (F.abs(rating) + F.abs("dot"))).alias(f"t{k}") for k in range(rank)]
    # A user's factor is the same in all its rows; numbers, unlike an array, are kept in a hash aggregate.
    own = [F.max(x[k]).alias(f"x{k}") for k in range(rank)]
    users = rated.groupBy(*keys).agg(F.count(F.lit(1)).alias("ratings"), *own, *sums, *terms)
    if not wide:
        users = users.withColumnRenamed("user_number", "user_id")
    weight = F.lit(float(settings["regParam"])) * F.col("ratings")
    breaches = []
    for k in range(rank):
        x = F.col(f"x{k}")
        g = F.col(f"g{k}") + weight * x
        breach = F.when(x > 0, F.abs(g)).otherwise(F.greatest(-g, F.lit(0.0)))
        breaches.append(F.coalesce(F.try_divide(breach, F.col(f"t{k}") + weight * x), F.lit(0.0)))
    gap = F.array_max(F.array(*breaches))
    return users.select("user_id", "ratings", gap.alias("gap"), (gap <= tolerance).alias("optimal"))
