"""Category indices by frequency, for any number of categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.operators.joins import lookup_join
from starledger.operators.numbering import number_rows
from starledger.session import stage


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """(column, n, index): every category, the most frequent first, ties in order of the text.

    Counts are dealt by range of (n, category) and numbered range by range, so no label list
    is gathered anywhere: the driver sees one number per range. Nulls get no index.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc(column)]
    ranged = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = number_rows(ranged, "index", "category-counts")
    return stage(numbered.withColumn("index", F.col("index").cast("double")), "category-index")


def with_index(df: DataFrame, index: DataFrame, column: str, output: str) -> DataFrame:
    """``df`` with the index of its category. Nulls, and categories that ``index`` lacks, get
    the number of categories, one more than the last index."""
    known = index.select(column, F.col("index").alias(output))
    counts = index.select(column, "n")
    unseen = index.agg(F.count(F.lit(1)).cast("double")).scalar()
    joined = lookup_join(df, known, column, "left", key_counts=counts)
    return joined.select(*df.columns, F.coalesce(output, unseen).alias(output))
