"""Readers and writers: CSV, NDJSON and parquet under declared schemas."""
