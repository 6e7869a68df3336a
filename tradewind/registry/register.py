"""Registration of a query together with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.registry.contract import rendered
from tradewind.registry.oracle import sql
from tradewind.session import configure


class Register:
    """Queries of one section. A query takes (spark, folder); its result is rendered for comparison."""

    def __init__(self):
        self.entries: dict = {}

    def add(self, name: str, query: Callable[[SparkSession, str], DataFrame], text: str | None = None,
            extra: dict[str, str] | None = None) -> None:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rendered(query(configure(spark), folder))

        run.__name__, run.__doc__ = name, query.__doc__
        run.plain = query  # the result in its own types
        self.entries[name] = (run, sql(text, extra) if text else None)

    def query(self, name: str, text: str | None = None, extra: dict[str, str] | None = None):
        def decorate(function):
            self.add(name, function, text, extra)
            return function

        return decorate
