"""Structured Streaming: incremental application of a change log."""
