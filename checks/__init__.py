"""Registered queries over the driver tables, each with equivalent SQL where SQL can say it."""

from __future__ import annotations

import importlib

MODULES = ("rules", "journeys", "cleaning", "business", "tables", "profiles")


def all_queries() -> None:
    """Import every query module, which fills the registry."""
    for m in MODULES:
        importlib.import_module(f"checks.{m}")
