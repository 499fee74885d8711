"""Ratings analytics on Spark: streaming ingest, cleaning, ranked tables, features, models."""
