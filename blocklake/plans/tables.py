"""From raw blocks to a chain's tables: rules of columns as data, put together to one select a table.

A :class:`TableRule` says which rows of a raw block make a table and how each column comes about. Its columns are the fields
of an entity of the chain's model, in snake case, unless told otherwise; a field's raw member has the field's name. From the
same rules comes the schema by which raw blocks are read: numbers and JSON are read as text, so that a number written as
text, or too large for 64 bits, is read as well.

:func:`ingest` stores the parsed blocks once, and each table reads only the members it needs from there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.functions.project import camel, snake
from blocklake.operators import ingest as I
from blocklake.plans.specs import Model
from blocklake.sources.shared import stored

#: What is read from the raw member, and how it becomes a column, by kind.
KINDS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "text": ("string", lambda c: c),
    "lower": ("string", F.lower),
    "json": ("string", lambda c: c),
    "byte": ("string", lambda c: c.cast("tinyint")),
    "short": ("string", lambda c: c.cast("smallint")),
    "int": ("string", lambda c: c.cast("int")),
    "long": ("string", lambda c: c.cast("long")),
    "u64": ("string", lambda c: c.cast("decimal(20,0)")),
    "big": ("string", lambda c: c.cast("decimal(38,0)")),
    "bool": ("string", lambda c: c.cast("boolean")),
    "version": ("string", lambda c: F.when(c == "legacy", -1).otherwise(c.try_cast("smallint")).cast("smallint")),
    "hexbyte": ("string", lambda c: I.hex_to_int(c).cast("tinyint")),
    "hexshort": ("string", lambda c: I.hex_to_int(c).cast("smallint")),
    "hexint": ("string", lambda c: I.hex_to_int(c).cast("int")),
    "hexlong": ("string", I.hex_to_int),
    "hexu64": ("string", lambda c: I.hex_to_decimal(c).cast("decimal(20,0)")),
    "hexseconds": ("string", lambda c: F.timestamp_seconds(I.hex_to_int(c)).cast("timestamp_ntz")),
    "utcseconds": ("string", lambda c: F.timestamp_seconds(c.cast("long")).cast("timestamp_ntz")),
    "seconds": ("string", lambda c: F.timestamp_seconds(c.cast("long"))),
    "millis": ("string", lambda c: F.timestamp_millis(c.cast("long"))),
    "texts": ("array<string>", lambda c: c),
    "ints": ("array<int>", lambda c: c),
}


@dataclass(frozen=True)
class TableRule:
    """How a table comes out of raw blocks, and how it is laid out in files.

    ``path``: the array of a block whose members are the rows; the header's place (or "") for the table of blocks.
    ``kinds``: fields by kind (see KINDS, or a type of Spark), text if not named. ``sources``: raw members with other names.
    ``lists``: a list's field, the prefix of the columns that its first members go to, how many, and the column of the rest (or "").
    ``variants``: a prefix of fields and the ``type`` of rows that have them; raw members have no prefix. ``hidden``: more raw
    members, by column. ``drop``: fields that are no columns. ``sizes``: columns whose bytes are measured; ``list_sizes``: the name
    of a size column and the list fields that it adds up. ``finish``: a last step over the table.
    """

    table: str
    entity: str
    path: str
    kinds: dict[str, str] = field(default_factory=dict)
    sources: dict[str, str] = field(default_factory=dict)
    lists: tuple[tuple[str, str, int, str], ...] = ()
    variants: dict[str, str] = field(default_factory=dict)
    hidden: dict[str, str] = field(default_factory=dict)
    drop: str = ""
    sizes: str = ""
    list_sizes: dict[str, str] = field(default_factory=dict)
    finish: Callable[[DataFrame], DataFrame] | None = None
    height: str = ""
    rows: int = 10_000
    dictionary: str = ""
    statistics: str = ""


@dataclass(frozen=True)
class RawModel:
    """A chain's raw blocks: where a block's height is, of which kind, and its tables."""

    model: Model
    height: str
    tables: tuple[TableRule, ...]
    height_kind: str = "int"
    #: Tables that are no plain selects: made from the parsed blocks, with what else they read.
    more: Callable[[DataFrame], dict[str, DataFrame]] | None = None
    more_schema: str = ""


def _columns(model: Model, rule: TableRule) -> list[tuple[str, str, str, str | None]]:
    """``column, raw member, kind, type of rows that have it`` for all columns but those of lists."""
    kinds = {f: k for k, names in rule.kinds.items() for f in names.split()}
    leave = {*rule.drop.split(), *(x[0] for x in rule.lists)}
    out = []
    for f in model.fields[rule.entity]:
        if f in leave:
            continue
        tag = next((p for p in sorted(rule.variants, key=len, reverse=True) if f.startswith(p) and f != p), None)
        source = rule.sources.get(f) or (f[len(tag)].lower() + f[len(tag) + 1 :] if tag else f)
        column = model.renamed.get(snake(f), snake(f))
        out.append((column, source, kinds.get(f, "text"), rule.variants[tag] if tag else None))
    return out + [(c, source, kinds.get(c, "text"), None) for c, source in rule.hidden.items()]


def _kind(name: str) -> tuple[str, Callable[[Column], Column]]:
    return KINDS.get(name) or (name, lambda c: c)


def _add(tree: dict, path: str, kind: str) -> None:
    """Puts a member into a tree of structs; ``a[].b`` is member ``b`` of the members of array ``a``."""
    head, _, rest = path.partition(".")
    if not rest:
        tree.setdefault(head, kind)
        return
    inner = tree.setdefault(head, {})
    if isinstance(inner, dict):
        _add(inner, rest, kind)


def _type(tree: dict | str) -> T.DataType:
    if isinstance(tree, str):
        return T.StructType.fromDDL(f"x {tree}")["x"].dataType
    fields = [T.StructField(k.removesuffix("[]"), T.ArrayType(_type(v)) if k.endswith("[]") else _type(v)) for k, v in tree.items()]
    return T.StructType(fields)


def raw_schema(raw: RawModel) -> T.StructType:
    """The schema by which :func:`blocklake.sources.sinks.read_raw_blocks` reads a chain's blocks."""
    tree: dict = {}
    for rule in raw.tables:
        under = "".join(f"{p}{'' if rule.entity == 'block' else '[]'}." for p in rule.path.split(".")) if rule.path else ""
        for _, source, kind, _ in _columns(raw.model, rule):
            _add(tree, under + source, _kind(kind)[0])
        for name, *_ in rule.lists:
            _add(tree, under + name, "array<string>")
        if rule.variants:
            _add(tree, under + "type", "string")
        if rule.height:
            _add(tree, under + rule.height, "string")
    _add(tree, raw.height, "string")
    for name, kind in ((x.split(" ", 1)) for x in raw.more_schema.split(";") if x):
        _add(tree, name, kind)
    return _type(tree)


def table_of(raw: RawModel, rule: TableRule, blocks: DataFrame) -> DataFrame:
    """One table from parsed blocks: one select over its rows."""
    height = _kind(raw.height_kind)[1](F.col(raw.height)).cast("int")
    if rule.entity == "block":
        rows, at, out = blocks, f"{rule.path}." if rule.path else "", []
    else:
        rows = blocks.select(height.alias("block_number"), rule.path)
        for part in rule.path.split("."):
            rows = rows.select("block_number", F.explode(part).alias("r"))
        at, out = "r.", [F.col("block_number")]
    member = lambda source: F.col(at + ".".join(f"`{x}`" for x in source.split(".")))
    for column, source, kind, tag in _columns(raw.model, rule):
        value = _kind(kind)[1](height if rule.entity == "block" and column == "number" else member(source)) if not (rule.entity == "block" and column == "number") else height
        out.append((F.when(member("type") == tag, value) if tag else value).alias(column))
    for name, prefix, k, rest in rule.lists:
        first, left = I.split_list(member(name), k)
        out += [c.alias(f"{prefix}{i}") for i, c in enumerate(first)] + ([left.alias(rest)] if rest else [])
    length = lambda c: F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + F.length(x)), F.lit(0).cast("long"))
    out += [sum((length(member(c)) for c in names.split()[1:]), length(member(names.split()[0]))).alias(size) for size, names in rule.list_sizes.items()]
    made = rows.select(*out)
    return rule.finish(made) if rule.finish else made


def ingest(raw: RawModel, blocks: DataFrame, keep: bool = True) -> dict[str, DataFrame]:
    """All tables of a chain from its raw blocks, read by :func:`raw_schema`.

    With ``keep`` the parsed blocks are written to the shared folder once, and tables read them from there; else each table
    parses the text again. Members that are missing in a raw block are null in its rows, arrays that are missing have no rows,
    a header without a height makes rows without one; raw members that no rule names are not read. Rows that repeat stay.
    """
    parsed = stored(blocks, "raw-blocks") if keep else blocks
    out = {rule.table: table_of(raw, rule, parsed) for rule in raw.tables}
    return out | (raw.more(parsed) if raw.more else {})


def rule_of(raw: RawModel, table: str) -> TableRule | None:
    return next((r for r in raw.tables if r.table == table), None)


def indexed(model: Model, *names: str) -> dict[str, str]:
    """Hidden columns ``_evm_log_address`` from members ``_evmLogAddress``."""
    return {n: "_" + camel(n.lstrip("_")) for n in names}
