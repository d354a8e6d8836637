"""Incremental loading."""
