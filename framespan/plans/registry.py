"""Collects the registered queries of the plan modules."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from framespan.plans.fixtures import Views, with_views

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}
MODULES = ("scalars", "statistics", "alignment", "matching", "releases", "pixels", "files")


def query(name: str, sql: str | None = None):
    """Registers a function of Views under a name, with the SQL that gives the same rows."""

    def register(function: Callable[[Views], DataFrame]):
        _queries[name] = lambda spark, sf_dir: function(Views(spark, sf_dir))
        if sql:
            _sql[name] = with_views(sql)
        return function

    return register


def _load() -> None:
    for module in MODULES:
        import_module(f"framespan.plans.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
