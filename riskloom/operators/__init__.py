"""Relational operators: quality, preparation, metrics, drift, learning, monitoring."""
