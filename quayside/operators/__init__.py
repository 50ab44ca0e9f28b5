"""Operators on change logs, current-state tables, data quality, freshness and layout."""
