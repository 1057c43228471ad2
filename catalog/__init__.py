"""Every operator as a query over the test tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

import importlib

MODULES = ("logs", "identity", "geo", "sessions", "sketches", "cubes", "activity", "paths", "history", "profile", "text", "files")


def load() -> dict:
    """{name: (callable, sql or None)} over all families."""
    found: dict = {}
    for name in MODULES:
        found.update(importlib.import_module(f"catalog.{name}").QUERIES.entries)
    return found
