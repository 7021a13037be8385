"""Registered queries over the given tables."""

from __future__ import annotations

import importlib

MODULES = ["stores", "links", "content", "records", "quality", "reports", "joins", "stateful", "flagship"]


def load():
    """All registered queries by name."""
    for module in MODULES:
        importlib.import_module(f"curiomill.catalog.{module}")
    from curiomill.catalog.registry import QUERIES

    return QUERIES
