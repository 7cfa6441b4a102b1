"""Retail sales analytics on Spark: ingestion, batch views, running aggregates, scoring, comparison."""
