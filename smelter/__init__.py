"""Medallion analytics for e-commerce data, written as plain Spark DataFrame jobs."""
