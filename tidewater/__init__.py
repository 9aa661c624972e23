"""Lakehouse pipelines as plain DataFrame operators on stock Spark."""
