"""Table operators: ingest, lookups, de-duplication, evaluation, features, training."""
