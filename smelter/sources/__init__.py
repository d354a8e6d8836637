"""Readers: raw CSV files and layer tables."""
