"""Landed JSON responses into well-kept tables, on Spark."""
