import hashlib

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from starledger.operators.sampling import hash_sample, hash_split, with_fold


@pytest.fixture
def pairs(spark):
    return spark.range(5000).select((F.col("id") % 97).alias("u"), F.col("id").alias("i"))


def _digest(u, i):
    return hashlib.md5(f"{u}|{i}|42".encode()).hexdigest()


def test_split_is_a_partition_and_ignores_layout(pairs):
    train, test = hash_split(pairs, ["u", "i"])
    assert sorted(tuples(train) + tuples(test), key=repr) == tuples(pairs)
    assert 0.77 < train.count() / 5000 < 0.83
    for parts in (1, 3, 8):
        assert tuples(hash_split(pairs.repartition(parts), ["u", "i"])[1]) == tuples(test)


def test_fold_follows_the_digest(pairs):
    for row in with_fold(pairs, ["u", "i"]).limit(50).collect():
        assert row.fold == int(_digest(row.u, row.i)[:8], 16) % 10


@pytest.mark.parametrize("n", [1, 50, 4999, 5000, 6000])
def test_sample_is_the_n_smallest_digests(pairs, n):
    rows = sorted(tuples(pairs), key=lambda r: _digest(*r))[:n]
    for parts in (1, 8):
        assert tuples(hash_sample(pairs.repartition(parts), ["u", "i"], n)) == sorted(rows, key=repr)


def test_sample_of_one_repeated_key_is_still_whole(spark):
    same = spark.range(300).select(F.lit(1).alias("u"), F.lit(2).alias("i"))
    assert hash_sample(same, ["u", "i"], 100).count() == 100
    assert hash_sample(same.limit(0), ["u", "i"], 100).count() == 0


def test_seed_changes_the_sample(pairs):
    assert tuples(hash_sample(pairs, ["u", "i"], 50)) != tuples(hash_sample(pairs, ["u", "i"], 50, seed=1))
