"""Windowed consumer and incremental ingest."""
