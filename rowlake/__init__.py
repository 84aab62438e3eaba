"""Schema-on-arrival lake ingestion and schema evolution on Spark DataFrames."""
