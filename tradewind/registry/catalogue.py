"""Collects the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

SECTIONS = ("models", "expressions", "relations", "loading", "checks", "topics")


def _entries() -> dict[str, tuple[Query, str | None]]:
    collected: dict[str, tuple[Query, str | None]] = {}
    for section in SECTIONS:
        entries = import_module(f"tradewind.registry.{section}").REGISTER.entries
        repeated = collected.keys() & entries.keys()
        if repeated:
            raise ValueError(f"registered twice: {sorted(repeated)}")
        collected.update(entries)
    return collected


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in _entries().items() if text}
