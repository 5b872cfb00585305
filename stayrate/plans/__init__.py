"""Named queries over the subscriber view."""

from __future__ import annotations

from importlib import import_module

MODULES = [
    "sql_reports", "table_reports", "quality", "features", "encoding", "statistics", "scoring", "io", "streams", "models",
]


def load_all():
    """Import every plan module once and return the registry."""
    for name in MODULES:
        import_module(f"stayrate.plans.{name}")
    return import_module("stayrate.plans.registry")
