"""The pipeline as jobs over tables by path.

Published tables carry wire names and are read under plain ones. Every job is safe to
run again: all but the stream overwrite their output, and the stream resumes.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starledger.operators.complete import complete_rows
from starledger.operators.metrics import histogram, regression_metrics
from starledger.operators.sampling import hash_split
from starledger.plans import features, gold, recommender, silver, training, trees, views
from starledger.schemas import (
    COMPARISON_SCHEMA,
    IMPORTANCE_SCHEMA,
    ITEM_RANKING_SCHEMA,
    PREDICTION_SCHEMA,
    to_wire,
    wire_slot,
)
from starledger.session import GROUP_BYTES, stage
from starledger.sources.compaction import TARGET_BYTES, compact_days, read_days
from starledger.sources.tables import is_empty, read_items_and_rejects, read_table, safe_read_table, write_table
from starledger.streaming import ingest


@dataclass(frozen=True)
class Lake:
    """Where the tables of one pipeline live, and in which format."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"

    # The folders of the published tables.
    bronze = "bronze/ratings"
    bronze_checkpoint = "bronze/checkpoints/ratings"
    # Not published by the original: the text of records that could not be read.
    rejects = "bronze/rejects"
    rejects_checkpoint = "bronze/checkpoints/rejects"
    compacted = "bronze/ratings_compacted"
    item_rejects = "silver/item_rejects"
    enriched = "silver/ratings_enriched"
    items = "silver/items"
    most_rated = "gold/most_rated_movies"
    top_rated = "gold/top_rated_movies"
    tag_stats = "gold/genre_rating_stats"
    user_activity = "gold/user_activity_stats"
    pairs = "gold/ml_ratings_dataset"
    features = "gold/ml_features_dataset"
    comparison = "gold/model_comparison_results"
    importances = "gold/feature_importance_results"
    predictions = "gold/best_model_predictions"
    views = "views"
    models = "models"
    audit = "audit"
    run_log = "runs"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.path(table), self.fmt)

    def write(self, df: DataFrame, table: str, mode: str = "overwrite", replace_schema: bool = False) -> None:
        write_table(to_wire(df), self.path(table), self.fmt, mode, replace_schema=replace_schema)


def run_bronze(
    lake: Lake,
    source: str,
    options: Mapping[str, str],
    path: str | None = None,
    once: bool = False,
    interval: str | None = None,
    by_date: bool = False,
) -> StreamingQuery:
    """Start the stream from any source into the bronze table.

    ``by_date`` partitions the table by ``ingest_date``, the date of the batch.
    """
    raw = ingest.open_stream(lake.spark, source, options, path)
    events = to_wire(ingest.parse_events(raw))
    if by_date:
        events = events.withColumn("ingest_date", F.current_date())
    return ingest.append_stream(
        events,
        lake.path(lake.bronze),
        lake.path(lake.bronze_checkpoint),
        lake.fmt,
        partition_by=["ingest_date"] if by_date else (),
        once=once,
        interval=interval,
    )


def run_rejects(
    lake: Lake,
    source: str,
    options: Mapping[str, str],
    path: str | None = None,
    once: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Start a second stream that appends the text and source time of unreadable records,
    with a checkpoint of its own. The time is the record's in Kafka, the file's elsewhere."""
    raw = ingest.open_stream(lake.spark, source, options, path)
    time = "timestamp" if source == "kafka" else "_metadata.file_modification_time"
    return ingest.append_stream(
        ingest.dated_rejects(raw, time),
        lake.path(lake.rejects),
        lake.path(lake.rejects_checkpoint),
        lake.fmt,
        once=once,
        interval=interval,
    )


def run_inspect(lake: Lake, preview: int = 20) -> None:
    """Print what the bronze table holds, and its first ``preview`` rows by time and key.

    The rating distribution is written whole under ``views/``.
    """
    bronze = lake.read(lake.bronze)
    gold.table_profile(bronze).show(truncate=False)
    bronze.orderBy("ts", *training.PAIR, "rating").limit(preview).show(preview, truncate=False)
    _publish(lake, "bronze_rating_distribution", gold.rating_distribution(bronze), preview)


def _publish(lake: Lake, name: str, view: DataFrame, preview: int) -> None:
    """Write a view whole under ``views/``; print its first rows and how many it has."""
    table = f"{lake.views}/{name}"
    lake.write(view, table, replace_schema=True)
    view.show(preview, truncate=False)
    print(f"   {lake.read(table).count()} rows in {table}")


def run_compact(lake: Lake, before: str | None = None, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Rewrite the closed days of a bronze table by date to large files, beside it.

    Closed are the days before ``before``, or else before today. Returns the days rewritten;
    ``run_silver`` then reads those from the large files. For Parquet; table formats with a
    log of their own bring their own compaction.
    """
    if lake.fmt != "parquet":
        raise ValueError(f"compaction is for parquet tables, not {lake.fmt}")
    before = before or str(lake.spark.range(1).select(F.current_date()).first()[0])
    path, into = lake.path(lake.bronze), lake.path(lake.compacted)
    return compact_days(lake.spark, path, into, "ingest_date", before, target_bytes)


def _bronze(lake: Lake) -> DataFrame:
    """The bronze table, by its compacted days where there are any."""
    table = lake.read(lake.bronze)
    if lake.fmt == "parquet" and "ingest_date" in table.columns:
        return read_days(lake.spark, lake.path(lake.bronze), lake.path(lake.compacted), "ingest_date")
    return table


def run_silver(lake: Lake, items_csv: str, multiline: bool = False) -> None:
    """Bronze and the item file to the enriched ratings and the clean items.

    The enriched ratings are joined with the items as written, whose files have known
    sizes. Records of the item file that cannot be used are written with their reason.
    """
    raw_items, rejects = read_items_and_rejects(lake.spark, items_csv, multiline)
    lake.write(rejects, lake.item_rejects)
    lake.write(silver.clean_items(raw_items), lake.items)
    lake.write(silver.enrich(silver.clean_ratings(_bronze(lake)), lake.read(lake.items)), lake.enriched)


def run_gold(lake: Lake) -> None:
    """The five summary tables, each read from the columns it needs.

    ``top_rated`` filters the ranking just written instead of counting again. Tables
    are stored unsorted; the views sort.
    """
    ratings, items = lake.read(lake.enriched), lake.read(lake.items)
    totals = stage(gold.item_totals(ratings), "item-totals")
    lake.write(gold.rank_items(totals, items), lake.most_rated)
    lake.write(gold.with_enough_ratings(lake.read(lake.most_rated)), lake.top_rated)
    lake.write(gold.tag_totals(totals, items), lake.tag_stats)
    lake.write(gold.user_totals(ratings), lake.user_activity)
    lake.write(gold.model_input(ratings), lake.pairs)


def run_features(lake: Lake, train_only: bool = False) -> None:
    """The feature table. With ``train_only``, user and item statistics come from the
    training folds alone, so that no test rating tells about itself."""
    ratings = lake.read(lake.enriched)
    stats_from = hash_split(ratings, training.PAIR)[0] if train_only else None
    base = stage(features.features_base(ratings, lake.read(lake.items), stats_from), "features-base", GROUP_BYTES)
    lake.write(features.encode_features(base)[1], lake.features, replace_schema=True)


def _log(
    lake: Lake, name: str, params: Mapping[str, object], metrics: Mapping[str, float], artifact: str | None
) -> None:
    lake.write(training.run_record(lake.spark, name, params, metrics, artifact), lake.run_log, mode="append")


def run_als(lake: Lake, blocks: int = training.ALS_BLOCKS, seed: int = 42) -> dict[str, float]:
    """Train and score the recommender; save it and log the run with all it takes to repeat it.

    Ids beyond 32 bits are numbered; the tables of numbers are saved beside the model.
    """
    pairs = complete_rows(lake.read(lake.pairs).select("user_id", "item_id", "rating"))
    train, test = (stage(part, "als-split") for part in hash_split(pairs, training.PAIR))
    model = recommender.fit_recommender(train, seed=seed, blocks=blocks)
    scored = model.transform(test)
    metrics = regression_metrics(scored, "rating", "prediction").select("rmse", "mae").first().asDict()
    artifact = lake.path(f"{lake.models}/als")
    model.save(artifact)
    settings = {
        "model": "ALS",
        "dataset": lake.pairs,
        **training.ALS_SETTINGS,
        "nonnegative": True,
        "coldStartStrategy": "drop",
        "seed": seed,
        "blocks": blocks,
        "wide_ids": model.users is not None,
        "train_rows": train.count(),
        "test_rows": test.count(),
    }
    _log(lake, "ALS", settings, metrics, artifact)
    return metrics


def run_regression(lake: Lake) -> str:
    """Train and compare all regressors; publish results; return the best one's name.

    Train and test rows are written once and read by every fit.
    """
    table = lake.read(lake.features)
    train, test = training.labelled(table)
    train, test = (stage(part, "split", GROUP_BYTES) for part in (training.like_together(train), test))
    counts = {"train_rows": train.count(), "test_rows": test.count()}
    trained = []
    for name, (_, settings) in training.REGRESSORS.items():
        result = training.train_regressor(train, test, name)
        artifact = lake.path(f"{lake.models}/{name.lower().replace(' ', '_')}")
        training.save_model(result.model, artifact)
        _log(lake, name, {"model": name, "dataset": lake.features, **settings, **counts}, result.metrics, artifact)
        trained.append(result)
    lake.write(training.comparison_table(lake.spark, trained), lake.comparison, replace_schema=True)
    slots = [wire_slot(slot) for slot in features.slot_names(table)]
    lake.write(training.importance_table(lake.spark, trained, slots), lake.importances, replace_schema=True)
    lake.write(training.published_predictions(trained, test), lake.predictions, replace_schema=True)
    return training.best_of(trained).name


def run_audit(lake: Lake) -> None:
    """Check the saved models against the data they were trained on.

    ``audit/als_users``: per user, how far its factor is from the minimum of its loss.
    ``audit/tree_leaves``: per leaf of the decision tree, its prediction and the mean of the
    training rows that end there. ``audit/importances``: per tree model and slot, the
    published importance and the one recomputed from the saved nodes.
    """
    pairs = complete_rows(lake.read(lake.pairs).select("user_id", "item_id", "rating"))
    wide = not recommender.fits_32_bits(pairs)
    als = recommender.Recommender.load(lake.spark, lake.path(f"{lake.models}/als"), wide)
    train, _ = hash_split(pairs, training.PAIR)
    lake.write(recommender.optimality(als, train), f"{lake.audit}/als_users", replace_schema=True)

    table = lake.read(lake.features)
    slots = [wire_slot(slot) for slot in features.slot_names(table)]
    names = lake.spark.createDataFrame(list(enumerate(slots)), "feature int, feature_name string")
    found = None
    for name in training.TREE_MODELS:
        nodes = trees.node_table(lake.spark, lake.path(f"{lake.models}/{name.lower().replace(' ', '_')}"))
        if name == training.SINGLE_TREE:
            rows = training.labelled(table)[0].select(*training.PAIR, "label", "features")
            leaves = trees.leaf_means(trees.route(rows, nodes, depth=training.depth_of(name)))
            lake.write(leaves, f"{lake.audit}/tree_leaves", replace_schema=True)
        own = trees.node_importances(nodes, training.trees_count_alike(name)).withColumn("model_name", F.lit(name))
        found = own if found is None else found.unionByName(own)
    recomputed = found.join(names, "feature").select("model_name", "feature_name", F.col("importance").alias("recomputed"))
    both = lake.read(lake.importances).join(recomputed, ["model_name", "feature_name"], "left")
    lake.write(both.fillna(0.0, ["recomputed"]), f"{lake.audit}/importances", replace_schema=True)


def run_views(
    lake: Lake, n: int = 15, min_ratings: int = gold.MIN_RATINGS, model: str | None = None, preview: int = 20
) -> None:
    """Write every view whole under ``views/`` and print its first ``preview`` rows; tables
    not built yet are named and passed over."""
    spark = lake.spark

    def show(title: str, table: str, view, schema=None) -> None:
        df = safe_read_table(spark, lake.path(table), schema, lake.fmt)
        print(f"== {title}")
        if is_empty(df):
            print(f"   {table} is missing or empty")
        else:
            _publish(lake, title.lower().replace(" ", "_"), view(df), preview)

    show("Most rated items", lake.most_rated, lambda df: views.most_rated_items(df, n), ITEM_RANKING_SCHEMA)
    show(
        "Best rated items",
        lake.top_rated,
        lambda df: views.best_rated_items(df, min_ratings, n),
        ITEM_RANKING_SCHEMA,
    )
    show("Tags by ratings", lake.tag_stats, views.tags_by_count, "tag string, rating_count long, avg_rating double")
    show("Tags by mean", lake.tag_stats, views.tags_by_mean, "tag string, rating_count long, avg_rating double")
    show(
        "Most active users",
        lake.user_activity,
        lambda df: views.most_active_users(df, n),
        "user_id long, rating_count long, avg_user_rating double",
    )
    pairs = "user_id long, item_id long, rating double"
    show("Headline figures", lake.pairs, gold.headline_figures, pairs)
    show("Rating distribution", lake.pairs, gold.rating_distribution, pairs)
    show("Best model", lake.comparison, views.best_model, COMPARISON_SCHEMA)
    show("Model metrics", lake.comparison, views.metrics_long, COMPARISON_SCHEMA)
    show(
        "Feature importance",
        lake.importances,
        lambda df: views.importance_for_model(df, model) if model else df.orderBy("model_name", F.desc("importance")),
        IMPORTANCE_SCHEMA,
    )
    show("Actual and predicted", lake.predictions, views.actual_vs_predicted, PREDICTION_SCHEMA)
    show("Predicted and residual", lake.predictions, views.predicted_vs_residual, PREDICTION_SCHEMA)
    show("Residuals", lake.predictions, lambda df: histogram(df, "residual").orderBy("bin"), PREDICTION_SCHEMA)
