"""The named queries, gathered from their modules."""

from __future__ import annotations

import importlib

MODULES = ("bars", "joins", "indicators", "events", "documents", "scalars")


def load():
    """(queries, oracle SQL) by key."""
    from . import registry

    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return registry.QUERIES, {key: registry.sql(text) for key, text in registry.ORACLE.items()}
