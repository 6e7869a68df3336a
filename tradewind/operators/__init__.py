"""Relational building blocks the plans are composed from."""
