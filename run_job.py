"""Run one job of the pipeline: ``spark-submit run_job.py --root <folder> <job> ...``."""

from __future__ import annotations

import argparse

from starledger.plans import jobs
from starledger.plans.training import ALS_BLOCKS
from starledger.session import build_session, temporary_tables
from starledger.streaming.ingest import kafka_options


def parse() -> argparse.Namespace:
    parser = argparse.ArgumentParser()
    parser.add_argument("--root", required=True, help="folder of all tables")
    parser.add_argument("--format", default="parquet", help="table format, such as parquet or delta")
    sub = parser.add_subparsers(dest="job", required=True)

    bronze = sub.add_parser("bronze", help="stream events into the bronze table")
    bronze.add_argument("--source", default="kafka")
    bronze.add_argument("--path", help="folder of a file source")
    bronze.add_argument("--servers", help="Kafka bootstrap servers")
    bronze.add_argument("--topic", default="movie-ratings")
    bronze.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    bronze.add_argument("--once", action="store_true", help="stop when present data is read")
    bronze.add_argument("--interval", help="time between batches, such as '5 minutes'")
    bronze.add_argument("--by-date", action="store_true", help="partition the table by date of ingest")
    bronze.add_argument("--rejects", action="store_true", help="also keep the text of unreadable records")

    inspect = sub.add_parser("inspect", help="show what bronze holds")
    inspect.add_argument("--preview", type=int, default=20, help="rows to print")
    silver = sub.add_parser("silver", help="clean and enrich")
    silver.add_argument("--items", required=True, help="item file (CSV with header)")
    silver.add_argument("--multiline", action="store_true", help="quoted values may hold line breaks")
    compact = sub.add_parser("compact", help="rewrite the closed days of bronze to large files")
    compact.add_argument("--before", help="first day to leave alone; today by default")
    compact.add_argument("--megabytes", type=int, default=256, help="size of a file")
    sub.add_parser("gold", help="build the summary tables")
    features = sub.add_parser("features", help="build the feature table")
    features.add_argument("--train-only", action="store_true", help="statistics from the training folds alone")
    als = sub.add_parser("als", help="train the recommender")
    als.add_argument("--blocks", type=int, default=ALS_BLOCKS, help="tasks of either side; part of the model")
    als.add_argument("--seed", type=int, default=42)
    sub.add_parser("regression", help="train and compare the regressors")
    sub.add_parser("audit", help="check the saved models against their training rows")
    views = sub.add_parser("views", help="print all views")
    views.add_argument("--top", type=int, default=15)
    views.add_argument("--min-ratings", type=int, default=30)
    views.add_argument("--model")
    views.add_argument("--preview", type=int, default=20, help="rows to print of each view")
    return parser.parse_args()


def run_batch(lake: jobs.Lake, args: argparse.Namespace) -> None:
    """Any job but the stream; all of them have written their results when they end."""
    if args.job == "inspect":
        jobs.run_inspect(lake, args.preview)
    elif args.job == "silver":
        jobs.run_silver(lake, args.items, args.multiline)
    elif args.job == "compact":
        jobs.run_compact(lake, args.before, args.megabytes << 20).show(1000, truncate=False)
    elif args.job == "gold":
        jobs.run_gold(lake)
    elif args.job == "features":
        jobs.run_features(lake, args.train_only)
    elif args.job == "als":
        print(jobs.run_als(lake, args.blocks, args.seed))
    elif args.job == "regression":
        print("best model:", jobs.run_regression(lake))
    elif args.job == "audit":
        jobs.run_audit(lake)
    else:
        jobs.run_views(lake, args.top, args.min_ratings, args.model, args.preview)


def main() -> None:
    args = parse()
    lake = jobs.Lake(build_session(f"starledger {args.job}"), args.root, args.format)
    if args.job == "bronze":
        options = dict(option.split("=", 1) for option in args.option)
        if args.source == "kafka":
            if not args.servers:
                raise SystemExit("a Kafka source needs --servers")
            options = kafka_options(args.servers, args.topic, **options)
        how = {"path": args.path, "once": args.once, "interval": args.interval}
        streams = [jobs.run_bronze(lake, args.source, options, by_date=args.by_date, **how)]
        if args.rejects:
            streams.append(jobs.run_rejects(lake, args.source, options, **how))
        if not args.once:
            lake.spark.streams.awaitAnyTermination()  # either stream's error ends the job
        for stream in streams:
            stream.awaitTermination() if args.once else stream.stop()
    else:
        with temporary_tables(lake.spark):
            run_batch(lake, args)


if __name__ == "__main__":
    main()
