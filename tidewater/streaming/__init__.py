"""Incremental file ingestion."""
