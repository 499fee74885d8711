"""Splits and samples that give the same rows under any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.functions.hashing import digest_number, key_digest


def with_fold(df: DataFrame, keys: Sequence[str], folds: int = 10, seed: int = 42) -> DataFrame:
    """Add ``fold`` in 0..folds-1, a function of the key alone."""
    return df.withColumn("fold", F.pmod(digest_number(key_digest(keys, seed)), F.lit(folds)).cast("int"))


def hash_split(
    df: DataFrame, keys: Sequence[str], train_tenths: int = 8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test): the first ``train_tenths`` of ten folds against the others."""
    folded = with_fold(df, keys, seed=seed)
    train, test = F.col("fold") < train_tenths, F.col("fold") >= train_tenths
    return folded.filter(train).drop("fold"), folded.filter(test).drop("fold")


def hash_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest key digests; every row when there are fewer.

    Sorting the whole table for its top ``n`` would send ``n`` rows from every input
    partition to one task. One pass counts the rows per cell of the digest's range, cells
    growing by an eighth of a power of two: at most 385 of them, merged on the map side.
    The first cell by which ``n`` rows are reached is the cut; beneath it lie about a tenth
    more than ``n`` rows, and never fewer.
    """
    digest = key_digest(keys, seed)
    cell = F.floor(8 * F.log2(digest_number(digest, 12) + F.lit(1)))
    counted = df.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    reached = counted.select("cell", F.sum("n").over(Window.orderBy("cell")).alias("upto"))
    cut = reached.filter(F.col("upto") >= n).agg(F.coalesce(F.min("cell"), F.lit(8 * 48))).scalar()
    near = df.filter(cell <= cut)
    return near.orderBy(digest, *keys).limit(n)
