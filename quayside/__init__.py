"""Quayside: fare-data processing on PySpark DataFrames, SQL and Structured Streaming."""
