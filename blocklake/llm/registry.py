"""The queries of this subpackage, by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import importlib
import pkgutil

import blocklake.llm as here


def _all(what: str) -> dict:
    found: dict = {}
    for module in sorted(m.name for m in pkgutil.iter_modules(here.__path__)):
        if module != "registry":
            found |= getattr(importlib.import_module(f"blocklake.llm.{module}"), what, {})
    return found


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _all("SQL")
