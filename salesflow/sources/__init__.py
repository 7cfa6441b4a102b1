"""Readers and writers: Parquet tables, CSV, ORC, Kafka, file-backed topics, prediction files."""
