"""One row per key, chosen by rule rather than by arrival.

Everything here is an aggregate, so each map task sends at most one row per key:
a key whose copies make up a third of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def keep_greatest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Per key, the row that is greatest by ``order`` and then by all other columns."""
    rest = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    if not rest:
        return df.distinct()
    if len(rest) == 1 and isinstance(df.schema[rest[0]].dataType, _FIXED_WIDTH):
        return df.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0])).select(*df.columns)
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def keep_latest(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Per key, the row with the greatest ``at``; (keys, at) must be unique.

    Cleaned ratings are unique on (user, item, time). That lets fixed-width columns
    stay in a hash aggregate, where ``keep_greatest`` would have to sort.
    """
    others = [c for c in df.columns if c not in keys and c != at]
    picked = df.groupBy(*keys).agg(F.max(at).alias(at), *[F.max_by(c, at).alias(c) for c in others])
    return picked.select(*df.columns)
