"""Incremental and streaming ingestion."""
