"""Operators against plain Python on generated tables."""

import hashlib

from conftest import tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starledger.operators.dedupe import keep_greatest
from starledger.operators.joins import hot_keys, salted_join
from starledger.operators.sampling import hash_sample

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
small = st.integers(0, 4)
maybe = st.one_of(st.none(), st.sampled_from([0.5, 1.0, 4.5]))


@few
@given(st.lists(st.tuples(small, small, st.integers(0, 3), maybe), max_size=60))
def test_keep_greatest(spark, rows):
    df = spark.createDataFrame(rows, "u long, i long, ts long, r double")
    best = {}
    for u, i, ts, r in rows:
        rank = (ts, r is not None, r or 0.0)
        if (u, i) not in best or rank > best[u, i][0]:
            best[u, i] = (rank, (u, i, ts, r))
    assert tuples(keep_greatest(df, ["u", "i"], ["ts"])) == sorted((row for _, row in best.values()), key=repr)


@few
@given(
    st.lists(st.tuples(st.one_of(st.none(), small), st.integers(0, 99)), max_size=80, unique=True),
    st.sets(small),
    st.sampled_from(["inner", "left"]),
    st.integers(2, 40),
)
def test_salted_join(spark, facts, known, how, parts):
    left = spark.createDataFrame(facts, "k long, v long")
    right = spark.createDataFrame([(k, k * 10) for k in known], "k long, w long")
    got = salted_join(left, right, "k", how, left.groupBy("k").count().withColumnRenamed("count", "n"), parts)
    want = [(k, v, k * 10 if k in known else None) for k, v in facts if how == "left" or k in known]
    assert tuples(got) == sorted(want, key=repr)


@few
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=40), st.integers(2, 50))
def test_hot_keys_are_exactly_those_above_an_even_share(spark, counts, parts):
    df = spark.createDataFrame(list(enumerate(counts)), "k long, n long")
    hot = {r.k: r._slices for r in hot_keys(df, "k", parts).collect()}
    share = sum(counts) / parts
    assert set(hot) == {k for k, n in enumerate(counts) if n > share}
    assert all(counts[k] / slices <= share * (1 + 1e-9) for k, slices in hot.items())
    assert len(hot) < parts and sum(hot.values()) <= 2 * parts


@few
@given(st.lists(st.tuples(small, st.integers(0, 30)), max_size=60, unique=True), st.integers(1, 70))
def test_hash_sample(spark, rows, n):
    df = spark.createDataFrame(rows, "u long, i long")
    want = sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}|{r[1]}|42".encode()).hexdigest())[:n]
    assert tuples(hash_sample(df, ["u", "i"], n)) == sorted(want, key=repr)
