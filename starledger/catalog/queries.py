"""Named queries: each takes (spark, folder of test tables) and returns a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starledger.catalog import inputs
from starledger.catalog.inputs import Shared
from starledger.functions.events import encode_event, epoch_to_text, epoch_to_timestamp, time_parts
from starledger.functions.tags import split_tags, tag_count
from starledger.operators.categories import frequency_index, with_index
from starledger.operators.joins import lookup_join
from starledger.operators.metrics import histogram, regression_metrics
from starledger.operators.sampling import hash_sample, hash_split, with_fold
from starledger.plans import features, gold, recommender, ridge, silver, training, trees, views
from starledger.schemas import ITEM_RANKING_SCHEMA, RUN_LOG_SCHEMA, to_wire
from starledger.session import fresh_path, stage, workspace
from starledger.sources.compaction import compact_days, day_sizes, read_days
from starledger.sources.tables import (
    read_items_and_rejects,
    read_items_csv,
    read_table,
    safe_read_table,
    write_table,
)
from starledger.streaming import batches, ingest

PAIR = ["user_id", "item_id"]
MODEL_ITEM_MEAN = "Item mean"


# --- streaming ---------------------------------------------------------------


def _run_ingest(spark: SparkSession, records: str, bronze: str, checkpoint: str) -> None:
    stream = ingest.parse_events(ingest.open_stream(spark, "text", path=records))
    ingest.append_stream(stream, bronze, checkpoint, once=True).awaitTermination()


def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    records = inputs.record_files(spark, d)
    bronze, checkpoint = fresh_path(spark, "bronze"), fresh_path(spark, "bronze-checkpoint")
    _run_ingest(spark, records, bronze, checkpoint)
    return _gaps_filled(read_table(spark, bronze))


def _gaps_filled(bronze: DataFrame) -> DataFrame:
    """Null fields as -1 or empty text, which every client compares alike."""
    return bronze.fillna(-1).fillna("")


def stream_restart(spark: SparkSession, d: str) -> DataFrame:
    """Ingest, restart at the same checkpoint, and count: nothing is read twice."""
    records = inputs.record_files(spark, d)
    bronze, checkpoint = fresh_path(spark, "bronze"), fresh_path(spark, "bronze-checkpoint")
    _run_ingest(spark, records, bronze, checkpoint)
    _run_ingest(spark, records, bronze, checkpoint)
    return read_table(spark, bronze).agg(
        F.count(F.lit(1)).alias("records"),
        F.count("user_id").alias("parsed"),
        F.count("rating").alias("rated"),
        F.sum("item_id").alias("item_sum"),
    )


def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    source = fresh_path(spark, "replayed")
    events = inputs.with_replays(inputs.events(spark, d), ["event_id"])
    events.select("user_id", "item_id", "rating", "ts", epoch_to_timestamp(F.col("ts")).alias("at")).write.parquet(source)
    stream = ingest.open_stream(spark, "parquet", path=source, schema=spark.read.parquet(source).schema)
    # The delay spans the whole input, so no row of it counts as late.
    unique = ingest.drop_replays(stream, [*PAIR, "ts"], "at", "366 days").select(*PAIR, "ts")
    out = fresh_path(spark, "unique")
    ingest.append_stream(unique, out, fresh_path(spark, "unique-checkpoint"), once=True).awaitTermination()
    return read_table(spark, out)


def json_parse(spark: SparkSession, d: str) -> DataFrame:
    return _gaps_filled(ingest.parse_events(inputs.event_records(spark, d)))


def json_encode(spark: SparkSession, d: str) -> DataFrame:
    return inputs.events(spark, d).select("event_id", encode_event().alias("record"))


def stream_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Rejects streamed to a table, with a restart that adds nothing."""
    records = inputs.record_files(spark, d)
    rejects, checkpoint = fresh_path(spark, "rejects"), fresh_path(spark, "rejects-checkpoint")
    for _ in range(2):
        raw = ingest.open_stream(spark, "text", path=records)
        stream = ingest.dated_rejects(raw, "_metadata.file_modification_time")
        ingest.append_stream(stream, rejects, checkpoint, once=True).awaitTermination()
    return spark.read.parquet(rejects).filter("source_time IS NOT NULL").select("record")


def stream_replaced(spark: SparkSession, d: str) -> DataFrame:
    """Bronze through a sink called per batch, whose first call is lost after its write."""
    records, bronze, checkpoint = (fresh_path(spark, n) for n in ("records", "bronze", "bronze-checkpoint"))
    inputs.event_records(spark, d).write.text(records)
    sink, lost = batches.replace_batch(bronze), []

    def write(rows: DataFrame, stream: str, batch: int) -> None:
        sink(rows, stream, batch)
        if not lost:
            lost.append(batch)
            raise RuntimeError("lost after the write, on purpose")

    for _ in range(2):
        events = ingest.parse_events(ingest.open_stream(spark, "text", path=records))
        try:
            batches.each_batch(events, checkpoint, write, once=True).awaitTermination()
        except StreamingQueryException:
            if len(lost) != 1:
                raise
    return _gaps_filled(read_table(spark, bronze).drop("stream", "batch"))


def stream_late(spark: SparkSession, d: str) -> DataFrame:
    """Records of three runs of a stream with replays: kept, or late by over ten days."""
    source, tables, checkpoint = (fresh_path(spark, n) for n in ("dealt", "late-tables", "late-checkpoint"))
    events = with_fold(inputs.events(spark, d), ["event_id"])
    run = F.col("fold") % 3
    replays = events.filter("fold = 0").withColumn("run", run + 1)
    rows = events.withColumn("run", run).unionByName(replays)
    rows = stage(rows.select(*PAIR, "rating", "ts", epoch_to_timestamp(F.col("ts")).alias("at"), "run"), "dealt-runs")
    for n in range(3):
        rows.filter(F.col("run") == n).drop("run").write.mode("append").parquet(source)
        stream = ingest.open_stream(spark, "parquet", path=source, schema=rows.drop("run").schema)
        write = batches.keep_late(tables, [*PAIR, "ts"], "at", "10 days")
        batches.each_batch(stream, checkpoint, write, once=True).awaitTermination()
    outcomes = [
        read_table(spark, f"{tables}/{name}").select(*PAIR, "rating", "ts", F.lit(name).alias("outcome"), "batch")
        for name in ("kept", "late")
    ]
    return outcomes[0].unionByName(outcomes[1])


def stream_state(spark: SparkSession, d: str) -> DataFrame:
    """The keys that replay removal remembers, read from its state."""
    source, checkpoint = fresh_path(spark, "stated"), fresh_path(spark, "stated-checkpoint")
    events = inputs.with_replays(inputs.events(spark, d), ["event_id"])
    events.select(*PAIR, "ts", epoch_to_timestamp(F.col("ts")).alias("at")).write.parquet(source)
    stream = ingest.open_stream(spark, "parquet", path=source, schema=spark.read.parquet(source).schema)
    unique = ingest.drop_replays(stream, [*PAIR, "ts"], "at", "366 days", lanes=1)
    ingest.append_stream(unique, fresh_path(spark, "stated-out"), checkpoint, once=True).awaitTermination()
    return batches.state_rows(spark, checkpoint).select(*PAIR, "ts")


def ingest_rejects(spark: SparkSession, d: str) -> DataFrame:
    return ingest.rejected_records(inputs.event_records(spark, d))


# --- sources and sinks ---------------------------------------------------------


def csv_dim_scan(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "items-csv")
    to_wire(inputs.raw_items(spark, d)).write.option("header", True).option("escape", '"').csv(path)
    return read_items_csv(spark, path)


def csv_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Two item files, one of damaged lines and one with line breaks in titles: the items
    read, and the rejected records with their reason."""
    lines, broken = fresh_path(spark, "items-lines"), fresh_path(spark, "items-broken")
    number, title, tags = F.col("item_id"), F.col("title"), F.col("tags")
    kind = F.col("fold")
    items = with_fold(inputs.raw_items(spark, d), ["item_id"])
    record = (
        F.when(kind == 0, F.concat(number, F.lit(',"'), title, F.lit(","), tags))
        .when(kind == 1, F.concat_ws(",", number, title))
        .when(kind == 2, F.concat(F.lit("n"), F.concat_ws(",", number, title, tags)))
        .when(kind == 3, F.concat_ws(",", F.lit(""), title, tags))
        .otherwise(F.concat_ws(",", number, title, tags))
    )
    # One column whose name is the header, and no quoting: every file is the lines as they are.
    raw = {"header": True, "sep": "\x01", "quote": "", "ignoreLeadingWhiteSpace": False}
    items.select(record.alias("movieId,title,genres")).write.options(**raw).csv(lines)
    in_two = items.withColumn("title", F.replace(title, F.lit(" "), F.lit("\n"))).drop("fold")
    to_wire(in_two).write.option("header", True).option("escape", '"').csv(broken)
    read, rejects = read_items_and_rejects(spark, lines)
    whole, none = read_items_and_rejects(spark, broken, multiline=True)
    good = read.withColumn("file", F.lit("lines")).unionByName(whole.withColumn("file", F.lit("breaks")))
    bad = rejects.withColumn("file", F.lit("lines")).unionByName(none.withColumn("file", F.lit("breaks")))
    good = good.select("file", F.lit("read").alias("outcome"), F.concat_ws(",", "item_id", "title", "tags").alias("record"))
    return good.unionByName(bad.withColumnRenamed("reason", "outcome"))


def bronze_compacted(spark: SparkSession, d: str) -> DataFrame:
    """Bronze by day of rating from three streamed batches, closed days compacted: every
    row, and the number of files that its day has."""
    records, bronze, checkpoint = (fresh_path(spark, n) for n in ("records", "bronze", "bronze-checkpoint"))
    compacted = fresh_path(spark, "compacted")
    folded = with_fold(inputs.events(spark, d), ["event_id"], folds=3).select("fold", encode_event().alias("value"))
    for n in range(3):
        folded.filter(F.col("fold") == n).select("value").write.mode("append").text(records)
        events = ingest.parse_events(ingest.open_stream(spark, "text", path=records))
        dated = events.withColumn("day", F.substring("rating_datetime", 1, 10))
        ingest.append_stream(dated, bronze, checkpoint, partition_by=["day"], once=True).awaitTermination()
    closed = "2024-01-20"
    compact_days(spark, bronze, compacted, "day", before=closed)
    files = day_sizes(spark, compacted, "day").select("day", F.col("files").alias("day_files"))
    rows = read_days(spark, bronze, compacted, "day").join(F.broadcast(files), "day", "left")
    return rows.select(*PAIR, "rating", "ts", F.col("day").cast("string"), F.coalesce("day_files", F.lit(-1)).alias("day_files"))


def write_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "roundtrip")
    rows = inputs.silver_ratings(spark, d)
    write_table(rows.select("user_id"), path)
    write_table(to_wire(rows), path)
    return _flat_silver(read_table(spark, path))


def schema_replace(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "replaced")
    write_table(inputs.raw_items(spark, d), path)
    write_table(gold.item_totals(inputs.clean_ratings(spark, d)), path, replace_schema=True)
    return read_table(spark, path)


def safe_read(spark: SparkSession, d: str) -> DataFrame:
    """A written table and a missing one, read alike."""
    path = fresh_path(spark, "ranking")
    write_table(_most_rated(spark, d), path)
    there = safe_read_table(spark, path, ITEM_RANKING_SCHEMA)
    return there.unionByName(safe_read_table(spark, fresh_path(spark, "missing"), ITEM_RANKING_SCHEMA))


# --- cleaning ------------------------------------------------------------------


def clean_ratings(spark: SparkSession, d: str) -> DataFrame:
    gaps = inputs.raw_ratings(spark, d).withColumns(
        {"rating": F.nullif("rating", F.lit(13.0)), "item_id": F.nullif("item_id", F.lit(5))}
    )
    return silver.clean_ratings(gaps)


def dedup_replay(spark: SparkSession, d: str) -> DataFrame:
    return silver.clean_ratings(inputs.with_replays(inputs.raw_ratings(spark, d), [*PAIR, "ts", "rating"]))


def dedup_dim(spark: SparkSession, d: str) -> DataFrame:
    items = inputs.raw_items(spark, d)
    again = items.withColumn("title", F.concat("title", F.lit(" (again)")))
    return silver.clean_items(items.unionByName(again)).select("item_id", "title", "tags")


def _flat_silver(rows: DataFrame) -> DataFrame:
    return rows.withColumn("tag_list", F.array_join("tags_array", ",")).drop("tags_array")


def enrich_silver(spark: SparkSession, d: str) -> DataFrame:
    return _flat_silver(inputs.silver_ratings(spark, d))


def epoch_to_datetime(spark: SparkSession, d: str) -> DataFrame:
    at = F.col("ts")
    return inputs.events(spark, d).select(
        "event_id", "ts", epoch_to_text(at).alias("rating_text"), epoch_to_timestamp(at).alias("rating_datetime")
    )


def time_features(spark: SparkSession, d: str) -> DataFrame:
    at = epoch_to_timestamp(F.col("ts"))
    return inputs.events(spark, d).select("event_id", *[part.alias(name) for name, part in time_parts(at).items()])


def split_tag_list(spark: SparkSession, d: str) -> DataFrame:
    return inputs.raw_items(spark, d).select("item_id", F.posexplode(split_tags(F.col("tags"))).alias("pos", "tag"))


def count_tags(spark: SparkSession, d: str) -> DataFrame:
    return inputs.raw_items(spark, d).select("item_id", tag_count(split_tags(F.col("tags"))).alias("tag_count"))


# --- gold ------------------------------------------------------------------------


def _most_rated(spark: SparkSession, d: str) -> DataFrame:
    return gold.most_rated(inputs.clean_ratings(spark, d), inputs.clean_items(spark, d))


def top_rated(spark: SparkSession, d: str) -> DataFrame:
    return gold.top_rated(_most_rated(spark, d))


def top_rated_min_n(spark: SparkSession, d: str) -> DataFrame:
    return views.best_rated_items(top_rated(spark, d), min_ratings=40, n=30)


def genre_stats(spark: SparkSession, d: str) -> DataFrame:
    return gold.tag_stats(inputs.clean_ratings(spark, d), inputs.clean_items(spark, d))


def user_activity(spark: SparkSession, d: str) -> DataFrame:
    return gold.user_activity(inputs.silver_ratings(spark, d))


def ml_dataset(spark: SparkSession, d: str) -> DataFrame:
    return gold.model_input(inputs.silver_ratings(spark, d))


def rating_distribution(spark: SparkSession, d: str) -> DataFrame:
    return gold.rating_distribution(inputs.raw_ratings(spark, d))


def table_profile(spark: SparkSession, d: str) -> DataFrame:
    return gold.table_profile(inputs.raw_ratings(spark, d))


def kpis(spark: SparkSession, d: str) -> DataFrame:
    return gold.headline_figures(ml_dataset(spark, d))


def top_n_items(spark: SparkSession, d: str) -> DataFrame:
    return views.most_rated_items(_most_rated(spark, d))


def top_n_users(spark: SparkSession, d: str) -> DataFrame:
    return views.most_active_users(user_activity(spark, d))


# --- features ----------------------------------------------------------------------


def user_features(spark: SparkSession, d: str) -> DataFrame:
    return features.user_features(inputs.silver_ratings(spark, d))


def item_features(spark: SparkSession, d: str) -> DataFrame:
    return features.item_features(inputs.silver_ratings(spark, d))


def genre_occurrence(spark: SparkSession, d: str) -> DataFrame:
    return features.tag_occurrence(inputs.clean_ratings(spark, d), inputs.clean_items(spark, d))


def main_genre(spark: SparkSession, d: str) -> DataFrame:
    return features.main_tags(inputs.clean_ratings(spark, d), inputs.clean_items(spark, d))


def features_base(spark: SparkSession, d: str) -> DataFrame:
    return Shared(spark, d).base()


def features_train_stats(spark: SparkSession, d: str) -> DataFrame:
    """Feature rows whose user and item statistics come from the training split alone."""
    ratings = Shared(spark, d).ratings()
    train, _ = hash_split(ratings, PAIR)
    return features.features_base(ratings, inputs.clean_items(spark, d), stats_from=train)


def index_category(spark: SparkSession, d: str) -> DataFrame:
    return Shared(spark, d).features().select("main_tag", "main_tag_index").distinct()


def one_hot(spark: SparkSession, d: str) -> DataFrame:
    """The slot of the one-hot vector that is set, and the number of slots."""
    slots = vector_to_array("main_tag_vec")
    return Shared(spark, d).features().select(
        *PAIR, "main_tag", (F.array_position(slots, 1.0) - 1).alias("slot"), F.size(slots).alias("slots")
    )


def feature_vector(spark: SparkSession, d: str) -> DataFrame:
    """The assembled vector: its numeric slots, its length, and which tag slot is set."""
    numeric = len(features.NUMERIC_FEATURES)
    rows = Shared(spark, d).features().select(*PAIR, vector_to_array("features").alias("v"))
    tag_slots = F.slice("v", numeric + 1, F.size("v") - numeric)
    return rows.select(
        *PAIR,
        *[F.col("v")[i].alias(f"slot_{i}") for i in range(numeric)],
        F.size("v").alias("slots"),
        (F.array_position(tag_slots, 1.0) + numeric - 1).alias("tag_slot"),
    )


# --- splits, samples, metrics ---------------------------------------------------------


def hash_split_query(spark: SparkSession, d: str) -> DataFrame:
    return with_fold(ml_dataset(spark, d), PAIR).select(*PAIR, (F.col("fold") < 8).alias("is_train"))


def hash_sample_query(spark: SparkSession, d: str) -> DataFrame:
    return hash_sample(stage(ml_dataset(spark, d), "pairs"), PAIR, training.PUBLISHED_PREDICTIONS)


def residuals(spark: SparkSession, d: str) -> DataFrame:
    """Test ratings predicted by their item's mean over the training split."""
    pairs = stage(ml_dataset(spark, d), "pairs")
    train, test = hash_split(pairs, PAIR)
    means = train.groupBy("item_id").agg(F.avg("rating").alias("predicted_rating"), F.count(F.lit(1)).alias("n"))
    known = stage(means.join(inputs.clean_items(spark, d).select("item_id", "title"), "item_id"), "item-means")
    predicted = lookup_join(test, known.drop("n"), "item_id", key_counts=known.select("item_id", "n"))
    return predicted.select(
        *PAIR,
        "title",
        F.col("rating").alias("actual_rating"),
        "predicted_rating",
        (F.col("rating") - F.col("predicted_rating")).alias("residual"),
        F.lit(MODEL_ITEM_MEAN).alias("model_name"),
    )


def regression_metrics_query(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(regression_metrics(residuals(spark, d), "actual_rating", "predicted_rating"))


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({m: F.round(m, 6) for m in ("rmse", "mae", "r2")})


def residual_histogram(spark: SparkSession, d: str) -> DataFrame:
    bins = histogram(stage(residuals(spark, d).select("residual"), "residuals"), "residual")
    return bins.withColumns({edge: F.round(edge, 6) for edge in ("bin_start", "bin_end")})


def actual_vs_predicted(spark: SparkSession, d: str) -> DataFrame:
    return views.actual_vs_predicted(stage(residuals(spark, d), "residuals"))


def predicted_vs_residual(spark: SparkSession, d: str) -> DataFrame:
    return views.predicted_vs_residual(residuals(spark, d))


def _mean_comparison(spark: SparkSession, d: str) -> DataFrame:
    """The user's and the item's mean of the feature table, compared as predictions."""
    rows = Shared(spark, d).base()
    means = {MODEL_ITEM_MEAN: "item_avg_rating", "User mean": "user_avg_rating"}
    compared = [
        regression_metrics(rows, "rating", column).select(F.lit(name).alias("model_name"), "rmse", "mae", "r2")
        for name, column in means.items()
    ]
    return _rounded(reduce(DataFrame.unionByName, compared))


def metrics_long(spark: SparkSession, d: str) -> DataFrame:
    return views.metrics_long(_mean_comparison(spark, d))


def best_model(spark: SparkSession, d: str) -> DataFrame:
    return views.best_model(_mean_comparison(spark, d))


def model_names(spark: SparkSession, d: str) -> DataFrame:
    return views.model_names(metrics_long(spark, d))


# --- models -----------------------------------------------------------------------------


# Fitted numbers differ from machine to machine in their last digits. These queries return
# what must hold of them whatever they are, computed from the models' own output.


def _als_split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The pairs, written once with their fold, as (train, test)."""
    folded = stage(with_fold(ml_dataset(spark, d), PAIR), "als-pairs")
    return folded.filter("fold < 8").drop("fold"), folded.filter("fold >= 8").drop("fold")


def _non_negative(scored: DataFrame) -> DataFrame:
    return scored.select(*PAIR, "rating", (~F.isnan("prediction") & (F.col("prediction") >= 0)).alias("non_negative"))


def als_predict(spark: SparkSession, d: str) -> DataFrame:
    """The test pairs that get a prediction, and whether it is a number of at least 0."""
    train, test = _als_split(spark, d)
    return _non_negative(training.fit_als(train).transform(test))


def als_wide_ids(spark: SparkSession, d: str) -> DataFrame:
    """``als_predict`` with ids that need 64 bits: the same pairs get a prediction."""
    wide = {"user_id": F.col("user_id") * F.lit(1 << 33) + 7, "item_id": F.col("item_id") - F.lit(1 << 40)}
    train, test = (part.withColumns(wide) for part in _als_split(spark, d))
    return _non_negative(recommender.fit_recommender(train).transform(test))


def als_optimality(spark: SparkSession, d: str) -> DataFrame:
    """Every trained user, its ratings, and whether its factor minimises its loss."""
    train, _ = _als_split(spark, d)
    return recommender.optimality(recommender.fit_recommender(train), train).drop("gap")


def _checked(predictions: DataFrame) -> DataFrame:
    """The predictions' keys, and whether residual and prediction make up the rating."""
    gap = F.abs(F.col("predicted_rating") + F.col("residual") - F.col("actual_rating"))
    return predictions.select(*PAIR, "title", "actual_rating", "model_name", "predicted_rating", (gap < 1e-9).alias("residual_agrees"))


def _mean_keeper(name: str):
    """Test rows of a model whose mean prediction over the training rows is their mean rating."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        train, test = Shared(spark, d).split()
        model = Shared(spark, d).trained(name).model
        mean = training.predictions_of(model, train, name).agg(F.round(F.avg("predicted_rating"), 6)).first()[0]
        checked = _checked(training.predictions_of(model, test, name)).drop("predicted_rating")
        return checked.withColumn("train_mean", F.lit(mean).cast("double"))

    return query


def reg_forest(spark: SparkSession, d: str) -> DataFrame:
    """Test rows, and whether each prediction lies within the ratings of the training rows."""
    name = training.FOREST
    train, test = Shared(spark, d).split()
    least, most = train.agg(F.min("label"), F.max("label")).first()
    checked = _checked(training.predictions_of(Shared(spark, d).trained(name).model, test, name))
    inside = F.col("predicted_rating").between(least - 1e-9, most + 1e-9)
    return checked.withColumn("in_range", inside).drop("predicted_rating")


def model_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Every model, its test rows, and whether its metrics are those of MLlib's own evaluator.

    Each model scores the test rows once; the predictions are written and read by both.
    """
    shared, metrics = Shared(spark, d), ("rmse", "mae", "r2")
    published = {r.model_name: r for r in training.comparison_table(spark, shared.all_trained()).collect()}
    rows = []
    for trained in shared.all_trained():
        scored = training.predictions_of(trained.model, shared.split()[1], trained.name)
        scored = stage(scored.select("actual_rating", "predicted_rating"), "scored")
        theirs = RegressionEvaluator(labelCol="actual_rating", predictionCol="predicted_rating")
        agrees = [abs(theirs.setMetricName(m).evaluate(scored) - published[trained.name][m]) < 1e-9 for m in metrics]
        rows.append((trained.name, scored.count(), *agrees))
    return spark.createDataFrame(
        rows, "model_name string, test_rows bigint, rmse_agrees boolean, mae_agrees boolean, r2_agrees boolean"
    )


def _importances(spark: SparkSession, d: str) -> DataFrame:
    shared = Shared(spark, d)
    return training.importance_table(spark, shared.all_trained(), features.slot_names(shared.features()))


def _shares(importances: DataFrame) -> DataFrame:
    total = F.round(F.sum("importance").over(Window.partitionBy("model_name")), 6)
    return importances.select("model_name", "feature_name", (F.col("importance") >= 0).alias("non_negative"), total.alias("model_total"))


def feature_importance(spark: SparkSession, d: str) -> DataFrame:
    return _shares(_importances(spark, d))


def importance_for_model(spark: SparkSession, d: str) -> DataFrame:
    return _shares(views.importance_for_model(_importances(spark, d), "GBT Regressor"))


def ridge_fit(spark: SparkSession, d: str) -> DataFrame:
    """Whether each weight of a fit in one pass is that of MLlib's linear models."""
    shared = Shared(spark, d)
    own = ridge.fit_ridge(shared.split()[0], penalty=0.1)
    slots = features.slot_names(shared.features())
    rows = []
    for name in ("Linear Regression", "Generalized Linear Regression"):
        model = shared.trained(name).model
        theirs = [*model.coefficients.toArray(), model.intercept]
        for slot, a, b in zip([*slots, "intercept"], [*own.coefficients, own.intercept], theirs, strict=True):
            rows.append((name, slot, bool(abs(a - b) <= 1e-6 * max(1.0, abs(b)))))
    return spark.createDataFrame(rows, "model_name string, feature_name string, agrees boolean")


def tree_routes(spark: SparkSession, d: str) -> DataFrame:
    """Test rows routed through the saved nodes: whether they meet the model's prediction."""
    shared, parts = Shared(spark, d), []
    test = shared.split()[1]
    for name in training.TREE_MODELS:
        nodes = trees.node_table(spark, shared.saved(name))
        routed = trees.route(test.select(*PAIR, "features"), nodes, depth=training.depth_of(name))
        found = trees.ensemble_predictions(routed, PAIR, averaged=training.trees_count_alike(name))
        both = training.predictions_of(shared.trained(name).model, test, name).join(found, PAIR, "left")
        agrees = F.coalesce(F.abs(F.col("routed_prediction") - F.col("predicted_rating")) < 1e-9, F.lit(False))
        parts.append(both.select(*PAIR, "model_name", agrees.alias("agrees")))
    return reduce(DataFrame.unionByName, parts)


def tree_leaf_means(spark: SparkSession, d: str) -> DataFrame:
    """Training rows, and whether the decision tree's leaf that they end in predicts the mean
    rating of the training rows there."""
    shared, name = Shared(spark, d), training.SINGLE_TREE
    nodes = trees.node_table(spark, shared.saved(name))
    rows = shared.split()[0].select(*PAIR, "label", "features")
    routed = stage(trees.route(rows, nodes, depth=training.depth_of(name)).drop("features", "prediction"), "routed")
    leaves = nodes.filter("left IS NULL").select("place", "prediction")
    means = stage(routed.groupBy("place").agg(F.avg("label").alias("mean"), F.count(F.lit(1)).alias("n")).join(leaves, "place"), "leaves")
    met = lookup_join(routed, means.drop("n"), "place", key_counts=means.select("place", "n"))
    return met.select(*PAIR, (F.abs(F.col("mean") - F.col("prediction")) < 1e-9).alias("agrees"))


def tree_importances(spark: SparkSession, d: str) -> DataFrame:
    """Whether each slot's importance is that recomputed from the saved nodes."""
    shared, rows = Shared(spark, d), []
    slots = features.slot_names(shared.features())
    for name in training.TREE_MODELS:
        nodes = trees.node_table(spark, shared.saved(name))
        found = {r.feature: r.importance for r in trees.node_importances(nodes, training.trees_count_alike(name)).collect()}
        published = shared.trained(name).model.featureImportances.toArray()
        rows += [(name, slot, bool(abs(found.get(i, 0.0) - published[i]) < 1e-9)) for i, slot in enumerate(slots)]
    return spark.createDataFrame(rows, "model_name string, feature_name string, agrees boolean")


def category_index(spark: SparkSession, d: str) -> DataFrame:
    """Feature rows with their main tag's index by frequency, numbered range by range, and
    whether MLlib's indexer gives the same."""
    table = Shared(spark, d).features().select(*PAIR, "main_tag", "main_tag_index")
    ranked = with_index(table, frequency_index(table, "main_tag"), "main_tag", "ranked_index")
    return ranked.select(*PAIR, "main_tag", "ranked_index", (F.col("ranked_index") == F.col("main_tag_index")).alias("agrees"))


def best_predictions(spark: SparkSession, d: str) -> DataFrame:
    """The published sample, and whether it is of the model that the comparison puts first."""
    shared = Shared(spark, d)
    first = views.best_model(training.comparison_table(spark, shared.all_trained())).first().model_name
    sample = _checked(training.published_predictions(shared.all_trained(), shared.split()[1]))
    return sample.withColumn("of_best", F.col("model_name") == first).drop("model_name", "predicted_rating")


def run_log(spark: SparkSession, d: str) -> DataFrame:
    """Settings of every run, and which metrics and artifacts it logged, read back.

    Each saved model is loaded again; ``agrees`` tells whether the metrics logged for it are
    those of the model before it was saved.
    """
    shared = Shared(spark, d)
    log = fresh_path(spark, "run-log")
    for trained in shared.all_trained():
        artifact = fresh_path(spark, "model")
        training.save_model(trained.model, artifact)
        loaded = type(trained.model).load(artifact)
        scored = training.predictions_of(loaded, shared.split()[1], trained.name)
        metrics = regression_metrics(scored, "actual_rating", "predicted_rating").first().asDict()
        record = training.run_record(
            spark, trained.name, training.REGRESSORS[trained.name][1], metrics, artifact.removeprefix(workspace(spark))
        )
        write_table(record, log, mode="append")
    kept = [(t.name, "metric", k, float(v)) for t in shared.all_trained() for k, v in t.metrics.items()]
    before = spark.createDataFrame(kept, "run_name string, kind string, key string, was double")
    rows = read_table(spark, log, schema=RUN_LOG_SCHEMA).join(before, ["run_name", "kind", "key"], "left")
    same = F.abs(F.expr("try_cast(value AS DOUBLE)") - F.col("was")) < 1e-9
    is_metric = F.col("kind") == "metric"
    return rows.select(
        "run_name",
        "kind",
        "key",
        F.when(F.col("kind") == "param", F.col("value")).otherwise("").alias("setting"),
        F.when(is_metric, F.coalesce(same, F.lit(False))).otherwise(F.col("value").isNotNull()).alias("agrees"),
    )


QUERIES = {
    "stream_ingest": stream_ingest,
    "stream_restart": stream_restart,
    "stream_dedup": stream_dedup,
    "json_parse": json_parse,
    "json_encode": json_encode,
    "ingest_rejects": ingest_rejects,
    "stream_rejects": stream_rejects,
    "stream_replaced": stream_replaced,
    "stream_late": stream_late,
    "stream_state": stream_state,
    "csv_dim_scan": csv_dim_scan,
    "csv_rejects": csv_rejects,
    "bronze_compacted": bronze_compacted,
    "write_roundtrip": write_roundtrip,
    "schema_replace": schema_replace,
    "safe_read_table": safe_read,
    "clean_ratings": clean_ratings,
    "dedup_replay": dedup_replay,
    "dedup_dim": dedup_dim,
    "enrich_silver": enrich_silver,
    "epoch_to_datetime": epoch_to_datetime,
    "time_features": time_features,
    "split_tags": split_tag_list,
    "genre_count": count_tags,
    "most_rated": _most_rated,
    "top_rated": top_rated,
    "top_rated_min_n": top_rated_min_n,
    "genre_stats": genre_stats,
    "user_activity": user_activity,
    "ml_dataset": ml_dataset,
    "rating_distribution": rating_distribution,
    "table_profile": table_profile,
    "kpis": kpis,
    "top_n_items": top_n_items,
    "top_n_users": top_n_users,
    "user_features": user_features,
    "item_features": item_features,
    "genre_occurrence": genre_occurrence,
    "main_genre": main_genre,
    "features_base": features_base,
    "features_train_stats": features_train_stats,
    "index_category": index_category,
    "category_index": category_index,
    "one_hot": one_hot,
    "feature_vector": feature_vector,
    "hash_split": hash_split_query,
    "hash_sample": hash_sample_query,
    "residuals": residuals,
    "regression_metrics": regression_metrics_query,
    "residual_histogram": residual_histogram,
    "actual_vs_predicted": actual_vs_predicted,
    "predicted_vs_residual": predicted_vs_residual,
    "metrics_long": metrics_long,
    "best_model": best_model,
    "model_names": model_names,
    "als_predict": als_predict,
    "als_wide_ids": als_wide_ids,
    "als_optimality": als_optimality,
    "reg_linear": _mean_keeper("Linear Regression"),
    "reg_tree": _mean_keeper("Decision Tree Regressor"),
    "reg_forest": reg_forest,
    "reg_gbt": _mean_keeper("GBT Regressor"),
    "reg_glr": _mean_keeper("Generalized Linear Regression"),
    "ridge_fit": ridge_fit,
    "tree_routes": tree_routes,
    "tree_leaf_means": tree_leaf_means,
    "tree_importances": tree_importances,
    "model_comparison": model_comparison,
    "feature_importance": feature_importance,
    "importance_for_model": importance_for_model,
    "best_predictions": best_predictions,
    "run_log": run_log,
}
