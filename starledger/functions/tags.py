"""Tag lists held as ``A|B|C`` text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_tags(tags: Column, trim: bool = False) -> Column:
    """Text to an array of tags. Empty text gives one empty tag."""
    parts = F.split(tags, r"\|")
    return F.transform(parts, lambda tag: F.trim(tag)) if trim else parts


def tag_count(tags_array: Column) -> Column:
    """Number of tags; null for a null array."""
    return F.when(tags_array.isNotNull(), F.size(tags_array))


def main_tag(tags_array: Column) -> Column:
    """The tag that occurs most often in the array, the earliest one on ties."""
    ranked = F.transform(
        tags_array,
        lambda tag, pos: F.struct(
            F.size(F.filter(tags_array, lambda other: other == tag)).alias("times"),
            (-pos).alias("earliness"),
            tag.alias("tag"),
        ),
    )
    return F.array_max(ranked)["tag"]
