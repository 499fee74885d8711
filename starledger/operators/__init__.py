"""DataFrame-to-DataFrame operators: de-duplication, lookups, sampling, metrics."""
