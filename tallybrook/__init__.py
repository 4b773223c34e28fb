"""Invoice risk analytics on Spark: ingest, dedup, rules, features, scores, checks."""
