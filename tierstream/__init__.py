"""Layered (bronze, silver, gold) stream processing on plain Spark."""
