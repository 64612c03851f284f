"""Marketplace analytics on Spark: cleaning, quality checks, marts and reports."""
