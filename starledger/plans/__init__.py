"""The pipeline: bronze to silver to gold, features, training, views and jobs."""
