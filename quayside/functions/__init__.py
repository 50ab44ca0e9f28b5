"""Helpers shared by operators and queries."""
