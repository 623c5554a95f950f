"""Projection of rows to output structs, and the scalar functions that it uses."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The greatest whole number that a double holds without loss.
SAFE_INTEGER = 2**53 - 1


def camel(name: str) -> str:
    """snake_case to camelCase."""
    return re.sub(r"_([a-z0-9])", lambda m: m[1].upper(), name)


def snake(name: str) -> str:
    """camelCase to snake_case: a capital after a small letter or digit, or before a small one, starts a word."""
    return re.sub(r"(?<=[a-z0-9])([A-Z])|(?<=[A-Za-z0-9])([A-Z])(?=[a-z])", lambda m: "_" + m[0], name).lower()


def selected_fields(mandatory: tuple[str, ...], wanted: dict[str, bool] | list[str]) -> list[str]:
    """Mandatory fields, then requested ones in their order, each once."""
    asked = [k for k, on in wanted.items() if on] if isinstance(wanted, dict) else wanted
    return list(dict.fromkeys([*mandatory, *asked]))


def json_object(value: Column, keep_nulls: bool = True) -> Column:
    """Struct to JSON text. Nulls are members unless told otherwise."""
    return F.to_json(value, {"ignoreNullFields": str(not keep_nulls).lower()})


def as_text(c: Column) -> Column:
    """Numbers that JSON readers would round."""
    return c.cast("string")


def embedded_json(c: Column) -> Column:
    """JSON text as a value that is written inline, not as a string."""
    return F.try_parse_json(c)


def epoch_seconds(c: Column, kind: str = "timestamp") -> Column:
    """Seconds since 1970; columns that have numbers already pass."""
    return c.cast("long") if kind in ("bigint", "int", "long") else F.unix_seconds(c.cast("timestamp"))


def epoch_millis(c: Column, kind: str = "timestamp") -> Column:
    return c.cast("long") if kind in ("bigint", "int", "long") else F.unix_millis(c.cast("timestamp"))


def safe_integer(c: Column) -> Column:
    """A variant: a number where a double holds it, else its text."""
    return F.when(c <= F.lit(SAFE_INTEGER), F.try_parse_json(c.cast("string"))).otherwise(F.try_parse_json(F.concat(F.lit('"'), c.cast("string"), F.lit('"'))))


def compact_list(*columns: Column) -> Column:
    """The columns as a list, without nulls."""
    return F.array_compact(F.array(*columns))


def list_with_rest(columns: list[Column], rest: Column) -> Column:
    """Prefix columns without nulls, then the rest; a null rest adds nothing."""
    head = F.array_compact(F.array(*columns))
    return F.when(rest.isNull(), head).otherwise(F.concat(head, rest))


def version_or_legacy(c: Column) -> Column:
    return F.when(c < 0, F.lit("legacy")).otherwise(c.cast("string"))


def version_json(c: Column) -> Column:
    """A version as JSON: its number, or the text ``legacy`` if it is negative."""
    return embedded_json(F.when(c < 0, F.lit('"legacy"')).otherwise(c.cast("string")))


def struct_of(columns: dict[str, Column]) -> Column:
    """A struct of several columns; members may be null, the struct is always there."""
    return F.struct(*[c.alias(k) for k, c in columns.items()])


def rekeyed(c: Column, names: dict[str, str], text: tuple[str, ...] = ()) -> Column:
    """A struct with other member names, some members as text; null stays null."""
    return F.when(c.isNotNull(), F.struct(*[(c[old].cast("string") if old in text else c[old]).alias(new) for old, new in names.items()]))


def tagged(tag: Column, variants: dict[str, dict[str, Column]]) -> Column:
    """A variant-typed object with the members of the row's own variant: null for a tag that is none of them."""
    out = F.lit(None).cast("string")
    for name, members in variants.items():
        out = F.when(tag == name, F.to_json(F.struct(*[c.alias(k) for k, c in members.items()]), {"ignoreNullFields": "false"})).otherwise(out)
    return F.try_parse_json(out)


def without_prefix(name: str, prefixes: tuple[str, ...]) -> str:
    """``coinOwner`` to ``owner`` for the first prefix that fits."""
    for p in prefixes:
        if name.startswith(p) and len(name) > len(p):
            rest = name[len(p) :]
            return rest[0].lower() + rest[1:]
    return name


def trace_members(kind: Column, action: dict[str, dict[str, Column]], result: dict[str, dict[str, Column]]) -> tuple[Column, Column]:
    """``action`` and ``result`` of a trace as JSON text by its type: null members go, and an object without members is null."""

    def by_kind(variants: dict[str, dict[str, Column]]) -> Column:
        out = F.lit(None).cast("string")
        for name, members in variants.items():
            if members:
                some = F.coalesce(*[c.isNotNull() & F.lit(True) for c in members.values()][:1])
                for c in members.values():
                    some = some | c.isNotNull()
                out = F.when((kind == name) & some, F.to_json(F.struct(*[c.alias(k) for k, c in members.items()]))).otherwise(out)
        return out

    return by_kind(action), by_kind(result)


def byte_size(c: Column) -> Column:
    """Bytes of a text; null has none."""
    return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")


def list_size(c: Column) -> Column:
    """Characters of all texts of a list; null has none."""
    return F.coalesce(F.aggregate(F.transform(c, lambda x: F.coalesce(F.length(x), F.lit(0)).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0).cast("long"))


def list_prefix(c: Column, n: Column | int) -> Column:
    return F.slice(c, F.lit(1), F.lit(n) if isinstance(n, int) else n)


def pop_back(c: Column) -> Column:
    return F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0)))
