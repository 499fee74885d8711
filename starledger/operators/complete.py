"""Rows that have all they need."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without null or NaN in ``columns`` (all columns by default).

    What ``dropna`` keeps, but as plain not-null tests, which Parquet scans can use.
    """
    tests = []
    for name in columns or df.columns:
        tests.append(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            tests.append(~F.isnan(name))
    return df.filter(reduce(lambda a, b: a & b, tests))
