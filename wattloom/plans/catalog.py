"""The registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wattloom.plans.oracle import with_tables

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Run
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None, *tables: str) -> Callable[[Run], Run]:
    """Register a query with the SQL that must give the same rows; ``tables`` are
    the bound tables the SQL reads besides the given ones."""

    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Entry(run, None if sql is None else with_tables(sql, *tables))
        return run

    return register


def load() -> dict[str, Entry]:
    """Import the query modules and return the registry."""
    from wattloom.plans import (  # noqa: F401
        queries_answers,
        queries_checks,
        queries_expressions,
        queries_joins,
        queries_rollups,
        queries_sources,
        queries_tables,
    )

    return REGISTRY
