"""Every registered query with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name``, with its SQL where SQL can say it."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"Query {name} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def load() -> None:
    """Import all modules that register queries."""
    from tidemark.catalog import entities, exports, history, ledger, shapes, streams  # noqa: F401
