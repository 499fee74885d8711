"""Hashes that depend on the row alone, never on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(keys: Sequence[str], seed: int = 42) -> Column:
    """Hex digest of the key columns and a seed."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def digest_number(digest: Column, digits: int = 8) -> Column:
    """The first hex digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")
