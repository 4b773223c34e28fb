"""Stores, batch and nightly jobs, and the query catalogue."""
