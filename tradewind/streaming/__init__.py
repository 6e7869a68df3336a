"""Event topics: ingestion, gated landing, versions of a landed table."""
