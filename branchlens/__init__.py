"""Branch analytics on Spark: ingest, keyed merges, shift facts and reports."""
