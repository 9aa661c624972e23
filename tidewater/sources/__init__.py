"""Readers: files, catalog tables and versioned snapshots."""
