"""Saved tree models as relations: rows routed by joins, importances from the nodes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.joins import fits_broadcast, lookup_join
from starledger.session import stage

#: The deepest tree that MLlib grows.
DEEPEST = 30
#: Nodes of a tree are told apart by the lower bits of their place.
_TREE = 1 << 31


def _saved(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame | None]:
    data = spark.read.parquet(f"{path}/data")
    try:
        weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("tree_weight"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return data.select(F.lit(0).alias("tree"), F.struct(*data.columns).alias("n")), None
    return data.select(F.col("treeID").alias("tree"), F.col("nodeData").alias("n")), weights


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a model saved at ``path``, one row each.

    (place, tree, node, prediction, gain, rows, feature, threshold, categories, left, right,
    tree_weight). ``left`` and ``right`` are places, null at a leaf. ``categories`` go left
    where a split is by category, else values up to ``threshold`` do. ``rows`` is the
    weighted number of rows that the node was grown from.
    """
    nodes, weights = _saved(spark, path)
    base = F.col("tree").cast("bigint") * _TREE
    inner = F.col("n.leftChild") >= 0
    values = F.col("n.split.leftCategoriesOrThreshold")
    by_category = F.col("n.split.numCategories") >= 0
    table = nodes.select(
        (base + F.col("n.id")).alias("place"),
        "tree",
        F.col("n.id").alias("node"),
        F.col("n.prediction").alias("prediction"),
        F.col("n.gain").alias("gain"),
        F.col("n.impurityStats")[0].alias("rows"),
        F.when(inner, F.col("n.split.featureIndex")).alias("feature"),
        F.when(inner & ~by_category, values[0]).alias("threshold"),
        F.when(inner & by_category, values).alias("categories"),
        F.when(inner, base + F.col("n.leftChild")).alias("left"),
        F.when(inner, base + F.col("n.rightChild")).alias("right"),
    )
    if weights is None:
        return table.withColumn("tree_weight", F.lit(1.0))
    return table.join(weights, "tree").select(*table.columns, "tree_weight")


def route(rows: DataFrame, nodes: DataFrame, features: str = "features", depth: int = DEEPEST) -> DataFrame:
    """``rows`` once per tree, with ``tree``, ``place`` of the leaf that each ends in, the
    leaf's ``prediction`` and the tree's ``tree_weight``.

    Every round joins the rows to the nodes they are at and moves them to a child, ``depth``
    times; rows at a leaf stay. The nodes are broadcast where their measured size allows; all
    rounds then run in one stage. Else each round shuffles, with the nodes that many rows are
    at, as the root, cut into slices.
    """
    nodes = stage(nodes, "nodes")
    # Bounded by the number of trees, a setting.
    trees = [r.tree for r in nodes.select("tree").distinct().collect()]
    started = rows.withColumns(
        {"_values": vector_to_array(features), "place": F.explode(F.array(*[F.lit(t * _TREE) for t in trees]))}
    )
    steps = nodes.select("place", "feature", "threshold", "categories", "left", "right")
    small = fits_broadcast(steps)
    value = F.col("_values")[F.col("feature")]
    goes_left = F.when(F.col("threshold").isNotNull(), value <= F.col("threshold")).otherwise(F.array_contains("categories", value))
    child = F.when(goes_left, F.col("left")).otherwise(F.col("right"))
    at = started
    for _ in range(depth):
        met = lookup_join(at, steps, "place", small=small)
        at = met.select(*rows.columns, "_values", F.when(F.col("left").isNull(), F.col("place")).otherwise(child).alias("place"))
    leaves = nodes.filter("left IS NULL").select("place", "tree", "prediction", "tree_weight")
    ended = lookup_join(at.drop("_values"), leaves, "place", "left", small=small)
    return ended.select(*rows.columns, "tree", "place", "prediction", "tree_weight")


def leaf_means(routed: DataFrame, label: str = "label") -> DataFrame:
    """(place, prediction, rows, mean) of every leaf that rows end in."""
    return routed.groupBy("place").agg(
        F.max("prediction").alias("prediction"), F.count(F.lit(1)).alias("rows"), F.avg(label).alias("mean")
    )


def ensemble_predictions(routed: DataFrame, keys: list[str], averaged: bool) -> DataFrame:
    """(keys, routed_prediction): the trees' predictions by their weights, added or averaged."""
    total = F.sum(F.col("prediction") * F.col("tree_weight"))
    value = total / F.sum("tree_weight") if averaged else total
    return routed.groupBy(*keys).agg(value.alias("routed_prediction"))


def node_importances(nodes: DataFrame, each_tree_alike: bool) -> DataFrame:
    """(feature, importance): the gain of its splits times the rows they split, as shares.

    ``each_tree_alike`` first gives every tree the same total, as forests do; boosted trees
    count by their gains. Features without a split are left out. One row per feature.
    """
    gains = nodes.filter("left IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"))
    if each_tree_alike:
        totals = gains.groupBy("tree").agg(F.sum("g").alias("all"))
        gains = gains.join(totals, "tree").filter("all > 0").withColumn("g", F.col("g") / F.col("all"))
    summed = gains.groupBy("feature").agg(F.sum("g").alias("g"))
    whole = summed.agg(F.sum("g")).scalar()
    return summed.select("feature", F.try_divide(F.col("g"), whole).alias("importance"))
