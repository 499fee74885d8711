"""The test tables in the shapes the pipeline reads.

Ratings are order lines: customer, part, quantity, order date. Items are parts.
Event records are the rows of ``events`` as JSON text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.functions.events import encode_event
from starledger.operators.sampling import with_fold
from starledger.plans import features, silver, training
from starledger.session import GROUP_BYTES, bound_tasks, fresh_path, pin, stage


# The columns read of each test table. Naming them saves a pass over
# the file footers to infer the schema.
COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bound_tasks(pin(spark)).read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("rating"),
        F.unix_timestamp("o_orderdate").alias("ts"),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("tags"),
    )


def clean_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_ratings(raw_ratings(spark, sf_dir))


def clean_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_items(raw_items(spark, sf_dir))


def silver_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.build_silver(raw_ratings(spark, sf_dir), raw_items(spark, sf_dir))


def with_replays(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows and, once more, the tenth of them that falls into one hash fold."""
    replay = with_fold(df, keys).filter(F.col("fold") == 0).drop("fold")
    return df.unionByName(replay)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ratings of the item named in their properties, to the second."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "user_id",
        F.from_json("props", "k BIGINT")["k"].alias("item_id"),
        F.col("value").alias("rating"),
        F.unix_timestamp("ts").alias("ts"),
    )


def event_records(spark: SparkSession, sf_dir: str, damaged: bool = True) -> DataFrame:
    """Events as JSON text. "error" events are not JSON, "signup" ones lack a number."""
    record = encode_event()
    if damaged:
        no_number = F.regexp_replace(record, '"rating":[^,]*', '"rating":"none"')
        record = (
            F.when(F.col("event_type") == "error", F.concat(F.lit("#"), record))
            .when(F.col("event_type") == "signup", no_number)
            .otherwise(record)
        )
    return events(spark, sf_dir).select(record.alias("value"))


def record_files(spark: SparkSession, sf_dir: str) -> str:
    """Event records as text files; returns their folder."""
    path = fresh_path(spark, "records")
    event_records(spark, sf_dir).write.text(path)
    return path


class Shared:
    """Tables and models that several queries read, built once per session and input.

    The pipeline writes its feature table once and trains from it; so do the queries.
    """

    _built: dict[tuple, object] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = bound_tasks(pin(spark)), sf_dir

    def _once(self, what: str, build):
        key = (self.spark.sparkContext.applicationId, self.sf_dir, what)
        if key not in self._built:
            self._built[key] = build()
        return self._built[key]

    def ratings(self) -> DataFrame:
        def build():
            return stage(silver_ratings(self.spark, self.sf_dir).select(*silver.RATING_COLUMNS), "silver", GROUP_BYTES)

        return self._once("ratings", build)

    def base(self) -> DataFrame:
        def build():
            items = clean_items(self.spark, self.sf_dir)
            return stage(features.features_base(self.ratings(), items), "features-base", GROUP_BYTES)

        return self._once("base", build)

    def features(self) -> DataFrame:
        return self._once("features", lambda: stage(features.encode_features(self.base())[1], "features", GROUP_BYTES))

    def split(self) -> tuple[DataFrame, DataFrame]:
        def build():
            train, test = training.labelled(self.features())
            return stage(training.like_together(train), "train", GROUP_BYTES), stage(test, "test", GROUP_BYTES)

        return self._once("split", build)

    def trained(self, name: str) -> training.Trained:
        return self._once(name, lambda: training.train_regressor(*self.split(), name))

    def saved(self, name: str) -> str:
        """The path where a trained model is saved."""

        def build():
            path = fresh_path(self.spark, "model")
            training.save_model(self.trained(name).model, path)
            return path

        return self._once(f"saved {name}", build)

    def all_trained(self) -> list[training.Trained]:
        return [self.trained(name) for name in training.REGRESSORS]
