"""Registry of queries, each with the SQL that gives the same rows in another engine."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from curiomill.catalog.derive import with_tables

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    name: str
    run: Run
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, tables: tuple[str, ...] = (), oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a query. ``oracle`` continues the ``WITH`` list of the derived tables it names."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        text = oracle.strip() if oracle is not None else None
        if text is not None and tables:
            text = f"WITH RECURSIVE {with_tables(*tables)}\n{text}"
        QUERIES[name] = Query(name, run, text)
        return run

    return register
