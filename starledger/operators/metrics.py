"""Error measures and distributions of numeric columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row with rmse, mae and r2, from a single aggregate."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction)
    squares = F.sum(error * error)
    spread = F.var_pop(y) * F.count(y)
    return df.filter(y.isNotNull() & F.col(prediction).isNotNull()).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.try_divide(squares, spread)).alias("r2"),
    )


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Rows per equal-width bin between the least and greatest value; bins count from 1.

    Nulls and NaN are left out. The greatest value belongs to the last bin. One value alone makes one bin.
    """
    x = F.col(column).cast("double")
    present = df.filter(x.isNotNull() & ~F.isnan(x))
    range_ = present.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo, hi = range_["lo"], range_["hi"]
    bin_ = F.when(lo == hi, F.lit(1)).otherwise(F.least(F.width_bucket(x, lo, hi, F.lit(bins)), F.lit(bins)))
    counts = present.groupBy(bin_.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    return counts.select(
        "bin",
        (lo + (F.col("bin") - 1) * width).alias("bin_start"),
        (lo + F.col("bin") * width).alias("bin_end"),
        "n",
    )
