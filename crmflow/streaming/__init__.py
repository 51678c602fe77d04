"""Incremental ingestion and streaming daily metrics."""
