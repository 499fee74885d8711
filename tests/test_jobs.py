"""The whole pipeline, job by job, over a small event file."""

import json

import pytest
from pyspark.sql import functions as F

from starledger.operators.sampling import hash_split
from starledger.plans import jobs, training


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lines, n = [], 0
    for user in range(1, 41):
        for item in range(1, 31):
            n += 1
            if (user * item) % 4 == 3:
                continue
            event = {
                "userId": user,
                "movieId": item,
                "rating": ((user + item) % 9 + 1) / 2,
                "timestamp": 1_600_000_000 + n * 3600,
            }
            lines.append(json.dumps(event))
    (root / "events").mkdir()
    (root / "events" / "a.txt").write_text("\n".join(lines) + "\nbroken\n")
    (root / "events" / "b.txt").write_text("\n".join(lines[:100]) + "\n")
    items = ["movieId,title,genres", *[f'{i},"Title, {i}",{"A|B" if i % 2 else "C"}' for i in range(1, 30)]]
    (root / "items.csv").write_text("\n".join(items) + "\n")
    saved = dict(training.REGRESSORS)
    for name, smaller in {"Random Forest Regressor": {"numTrees": 3}, "GBT Regressor": {"maxIter": 3}}.items():
        kind, settings = saved[name]
        training.REGRESSORS[name] = (kind, {**settings, **smaller})
    lake = jobs.Lake(spark, str(root))
    jobs.run_bronze(lake, "text", {}, str(root / "events"), once=True).awaitTermination()
    jobs.run_silver(lake, str(root / "items.csv"))
    jobs.run_gold(lake)
    jobs.run_features(lake)
    yield lake
    training.REGRESSORS.update(saved)


def _events(root):
    return len((root / "events" / "a.txt").read_text().split()) - 1


def test_layers_fit_together(lake, spark):
    bronze, enriched = lake.read(lake.bronze), lake.read(lake.enriched)
    known = bronze.filter("item_id < 30")
    assert bronze.filter("user_id is null").count() == 1
    assert known.count() == enriched.count() + known.count() - known.distinct().count()
    assert lake.read(lake.pairs).count() == enriched.count() == lake.read(lake.features).count()
    ranking, top = lake.read(lake.most_rated), lake.read(lake.top_rated)
    assert ranking.agg(F.sum("rating_count")).first()[0] == enriched.count()
    assert top.count() == ranking.filter("rating_count >= 30").count() > 0
    assert lake.read(lake.user_activity).count() == 40
    assert {r.tag for r in lake.read(lake.tag_stats).collect()} == {"A", "B", "C"}


def test_published_schemas(lake, spark):
    def published(table):
        return dict(spark.read.parquet(lake.path(table)).dtypes)

    assert published(lake.bronze) == {
        "userId": "bigint",
        "movieId": "bigint",
        "rating": "double",
        "timestamp": "bigint",
        "rating_datetime": "string",
    }
    assert list(published(lake.enriched)) == [
        "userId", "movieId", "title", "genres", "genres_array", "rating", "timestamp", "rating_datetime",
    ]
    assert list(published(lake.most_rated)) == ["movieId", "title", "genres", "rating_count", "avg_rating"]
    assert list(published(lake.tag_stats)) == ["genre", "rating_count", "avg_rating"]
    assert list(published(lake.user_activity)) == ["userId", "rating_count", "avg_user_rating"]
    assert list(published(lake.pairs)) == ["userId", "movieId", "rating"]
    assert list(published(lake.features)) == [
        "userId", "movieId", "title", "genres", "main_genre", "rating", "rating_year", "rating_month",
        "rating_dayofweek", "rating_hour", "genre_count", "user_rating_count", "user_avg_rating",
        "movie_rating_count", "movie_avg_rating", "main_genre_index", "main_genre_vec", "features",
    ]


def test_training_jobs(lake, spark, capsys):
    assert set(jobs.run_als(lake)) == {"rmse", "mae"}
    best = jobs.run_regression(lake)
    comparison = lake.read(lake.comparison)
    assert comparison.orderBy("rmse").first().model_name == best and comparison.count() == 5
    names = {r.feature_name for r in lake.read(lake.importances).collect()}
    assert {"genre_count", "movie_avg_rating", "main_genre_vec_A"} <= names
    assert {r.model_name for r in lake.read(lake.predictions).collect()} == {best}
    assert lake.read(lake.run_log).select("run_id").distinct().count() == 6

    jobs.run_inspect(lake)
    jobs.run_views(lake, model="GBT Regressor", preview=3)
    shown = capsys.readouterr().out
    assert "missing" not in shown and best in shown
    # Views are stored whole, whatever is printed.
    whole = spark.read.parquet(lake.path("views/predicted_and_residual")).count()
    assert whole == lake.read(lake.predictions).count() > 3 and f"{whole} rows" in shown

    logged = {(r.run_name, r.key): r.value for r in lake.read(lake.run_log).filter("kind = 'param'").collect()}
    assert logged["ALS", "blocks"] == "10" and logged["ALS", "seed"] == "42" and logged["ALS", "nonnegative"] == "True"
    pairs = lake.read(lake.pairs).count()
    assert int(logged["ALS", "train_rows"]) + int(logged["ALS", "test_rows"]) == pairs
    assert logged["GBT Regressor", "train_rows"] == logged["ALS", "train_rows"]

    jobs.run_audit(lake)
    users = lake.read(f"{lake.audit}/als_users")
    assert users.count() == 40 and users.filter("NOT optimal").isEmpty()
    assert lake.read(f"{lake.audit}/tree_leaves").filter("abs(mean - prediction) > 1e-9").isEmpty()
    shares = lake.read(f"{lake.audit}/importances")
    assert shares.count() == lake.read(lake.importances).count()
    assert shares.filter("abs(importance - recomputed) > 1e-9").isEmpty()

    # Rerunning replaces tables and appends runs.
    jobs.run_gold(lake)
    assert lake.read(lake.user_activity).count() == 40


def test_features_of_the_training_folds_alone(lake):
    ratings = lake.read(lake.enriched)
    train = ratings.join(hash_split(lake.read(lake.pairs), training.PAIR)[0].select(*training.PAIR), training.PAIR, "left_semi")
    want = {r.user_id: r["count"] for r in train.groupBy("user_id").count().collect()}
    whole = lake.read(lake.features).count()
    jobs.run_features(lake, train_only=True)
    try:
        rows = lake.read(lake.features).select("user_id", "user_rating_count").collect()
        assert len(rows) == whole
        assert all(r.user_rating_count == want.get(r.user_id, 0) for r in rows)
    finally:
        jobs.run_features(lake)


def test_views_of_an_empty_lake(spark, tmp_path, capsys):
    jobs.run_views(jobs.Lake(spark, str(tmp_path)))
    assert capsys.readouterr().out.count("is missing or empty") == 13
