"""Short forms for the lists in the chain models."""

from __future__ import annotations

from blocklake.functions.project import camel, snake
from blocklake.plans.specs import RelSpec, ScanSpec


def columns(names: str, **renamed: str) -> dict[str, str]:
    """Request names to columns: snake case, unless told otherwise."""
    return {n: renamed.get(n, snake(n)) for n in names.split()}


def columns_to_names(names: str) -> dict[str, str]:
    """Struct members to output names: camel case."""
    return {n: camel(n) for n in names.split()}


def scan(request: str, table: str | None = None, filters: str = "", fixed: dict[str, str] | None = None, at_least: dict | None = None, at_most: dict | None = None, equal: dict | None = None, **renamed: str) -> ScanSpec:
    return ScanSpec(request, table or snake(request), columns(filters, **renamed), fixed or {}, at_least or {}, at_most or {}, equal or {})


def parents(flag: str, scans: str, *on: tuple[str, str]) -> tuple[RelSpec, ...]:
    """``flag`` of each scan selects the item that its reference columns point to; ``on``: (item key, scan column)."""
    return tuple(RelSpec(s, flag, "parent", on) for s in scans.split())


def children(flag: str, scans: str, *on: tuple[str, str]) -> tuple[RelSpec, ...]:
    return tuple(RelSpec(s, flag, "children", on) for s in scans.split())


def tree(kind: str, flag: str, scans: str, on: tuple[tuple[str, str], ...], address: tuple[str, str], include_self: bool = False) -> tuple[RelSpec, ...]:
    return tuple(RelSpec(s, flag, kind, on, address, include_self) for s in scans.split())


def same(*names: str) -> tuple[tuple[str, str], ...]:
    return tuple((n, n) for n in names)
