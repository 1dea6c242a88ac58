"""Incremental ingest as a file-source stream."""
