"""Incremental ingestion of trip files."""
