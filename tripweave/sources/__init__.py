"""Readers that produce trip records."""
