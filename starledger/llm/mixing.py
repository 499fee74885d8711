"""Mixing sources to target weights by Poisson replication, all in DataFrame functions.

A source with target weight w of the whole and n of N rows is repeated w * N / n times on
average. Each document draws its count from the Poisson distribution with that mean by
inverting it at a uniform number that is a hash of the document and a seed: the draw needs
no agreement between tasks, a retried task repeats it, and totals meet the targets as the
law of large numbers has it. Copies are dealt to places of the output by hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.session import stage

#: Sources whose rates are broadcast, some 10 MB at most; more of them join by shuffle.
BROADCAST_SOURCES = 10_000
#: Means are drawn in parts of at most this size, so that exp(-mean) cannot vanish.
PART_MEAN = 16.0
#: Terms of the distribution beyond which a part of mean 16 has no probability left in doubles.
TERMS = 120
#: Production parameter: target weights follow the sources' sizes to this power.
FLATTEN = 0.5


def _unit(digest: Column, first: int) -> Column:
    """Twelve hex digits of a digest as a number from 0 to 1, 1 excluded."""
    return F.conv(F.substring(digest, first, 12), 16, 10).cast("double") / F.lit(float(16**12))


def repetition_rates(docs: DataFrame, source: str = "source", weights: Mapping[str, float] | None = None) -> DataFrame:
    """(source, rate): mean repetitions of a row so that sources meet their target weights.

    ``weights`` gives relative targets; a source it lacks gets none of the output, and with
    none of its sources present there is no output. A negative weight is a ValueError. Without
    it the targets are the sources' row counts to the power ``FLATTEN``. A null source is a
    source of its own, named by null. The output has as many rows as the input, on average.
    One row per source, counted on the map side first, so a hot source costs nothing extra.
    """
    if weights is not None and min(weights.values(), default=0) < 0:
        raise ValueError("weights may not be negative")
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    if weights is None:
        target = F.pow(F.col("_n").cast("double"), F.lit(FLATTEN))
    else:
        target = F.lit(0.0)
        for name, weight in weights.items():
            target = F.when(F.col("_source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(target)
    sizes = sizes.withColumn("_target", target)
    total = sizes.agg(F.sum("_n").alias("rows"), F.sum("_target").alias("target"))
    rows, whole = (total.select(c).scalar() for c in ("rows", "target"))
    return sizes.select("_source", F.coalesce(F.try_divide(F.col("_target") * rows, whole) / F.col("_n"), F.lit(0.0)).alias("_rate"))


def poisson_cdf(mean: Column, terms: int = TERMS) -> Column:
    """Array of P(count <= k) for k = 0 .. terms - 1."""
    step = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms - 1)),
        F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf")),
        lambda acc, k: F.struct(
            (acc.p * mean / k).alias("p"),
            F.concat(acc.cdf, F.array(F.element_at(acc.cdf, -1) + acc.p * mean / k)).alias("cdf"),
        ),
    )
    return step["cdf"]


def replicate(
    docs: DataFrame,
    keys: list[str],
    source: str = "source",
    weights: Mapping[str, float] | None = None,
    seed: int = 17,
) -> DataFrame:
    """Documents repeated to the target weights; adds ``copy`` (from 0) and ``place``.

    ``keys`` identify a document for the draw; rows with equal keys draw alike, and null
    keys are hashed as the empty text. ``place`` (0 to 1) is where the global shuffle puts
    the copy. An empty table gives an empty result. Columns of ``docs`` may have any names
    except ``copy`` and ``place``; those two are replaced.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("copy", "place")]).alias("_doc"),
        F.col(f"`{source}`").alias("_source"),
        F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]).alias("_key"),
    )
    # One row per source. Parts: a mean of 40 is drawn as three Poissons of a third each.
    rates = repetition_rates(docs, source, weights).withColumn(
        "_parts", F.greatest(F.ceil(F.col("_rate") / PART_MEAN), F.lit(1)).cast("int")
    )
    # A uniform number is below 1, so what has reached 1 is never passed.
    cdf = F.filter(poisson_cdf(F.col("_rate") / F.col("_parts")), lambda c: c < 1.0)
    rates = stage(rates.withColumn("_cdf", cdf), "mixing-rates")
    small = rates.count() <= BROADCAST_SOURCES
    joined = packed.join(F.broadcast(rates) if small else rates, packed["_source"].eqNullSafe(rates["_source"]))

    def draw(part: Column) -> Column:
        u = _unit(F.md5(F.concat_ws("|", "_key", part.cast("string"))), 1)
        return F.size(F.filter("_cdf", lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col("_parts")), F.lit(0), lambda acc, part: acc + draw(part))
    copies = joined.select("_doc", "_key", count.alias("_count")).filter("_count > 0")
    copies = copies.select("_doc", "_key", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)).alias("copy"))
    place = _unit(F.md5(F.concat_ws("|", "_key", F.lit("place"), F.col("copy").cast("string"))), 1)
    return copies.select("_doc.*", "copy", place.alias("place"))


def shuffled(mixed: DataFrame) -> DataFrame:
    """The copies in the order of ``place``, which is uniform, so that equal ranges of it
    make even partitions without a sample of the data."""
    parts = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionById(parts, F.floor(F.col("place") * parts).cast("int")).sortWithinPartitions("place", "copy")
