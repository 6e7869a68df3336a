"""Retail analytics on Spark: ingestion, staging, marts, history and data-quality gates."""
