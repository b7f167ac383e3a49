"""Scans, sinks, fitted tables, request parsing and the model registry."""
