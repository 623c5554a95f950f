"""What a chain model is made of: plain data that the query builder reads."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    """A table of a lake: its key besides ``block_number``, the weight of columns (a number or the name of a size column)."""

    name: str
    key: tuple[str, ...] = ()
    weights: dict[str, int | str] = field(default_factory=dict)
    sort: tuple[str, ...] = ()


@dataclass(frozen=True)
class ScanSpec:
    """A request list: its table, its filters (request name to column), fixed conditions, bounds, and relation flags."""

    request: str
    table: str
    filters: dict[str, str] = field(default_factory=dict)
    fixed: dict[str, str] = field(default_factory=dict)
    at_least: dict[str, str] = field(default_factory=dict)
    at_most: dict[str, str] = field(default_factory=dict)
    equal: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class RelSpec:
    """``flag`` of ``scan`` adds to an item what ``kind`` finds. Kinds: parent, children, at, descendants, ancestors, siblings.

    ``on``: pairs (item column, scan column) besides block_number; ``address``: (item column, scan column) of tree addresses.
    """

    scan: str
    flag: str
    kind: str
    on: tuple[tuple[str, str], ...] = ()
    address: tuple[str, str] | None = None
    include_self: bool = False


@dataclass(frozen=True, eq=False)
class ItemSpec:
    """An output collection: entity name in ``fields``, its table, the scans that select it, relations, mandatory fields."""

    name: str
    entity: str
    table: str
    scans: tuple[str, ...]
    relations: tuple[RelSpec, ...] = ()
    mandatory: tuple[str, ...] = ()


@dataclass(frozen=True)
class Model:
    name: str
    block: TableSpec
    tables: dict[str, TableSpec]
    scans: dict[str, ScanSpec]
    items: tuple[ItemSpec, ...]
    fields: dict[str, tuple[str, ...]]
    block_mandatory: tuple[str, ...] = ("number", "hash")
    #: Request list to items it selects, column names that differ from their snake-case field.
    renamed: dict[str, str] = field(default_factory=dict)
    #: For an entity's field a rule by name, or the struct members that are renamed (``:text``: and are text).
    projections: dict[str, dict[str, str | dict[str, str]]] = field(default_factory=dict)
