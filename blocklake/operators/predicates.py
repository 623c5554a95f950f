"""Filters of requests and scans: which rows of a table are asked for."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longer lists of values are joined as a table, so that plans stay small.
LONG_LIST = 1_000


def field_in(name: str, values: list | None) -> Column | None:
    """No condition for None, nothing at all for an empty list, else equality with one of the values."""
    if values is None:
        return None
    if not values:
        return F.lit(False)
    return F.col(name) == F.lit(values[0]) if len(values) == 1 else F.col(name).isin(list(values))


def field_gte(name: str, value) -> Column | None:
    return None if value is None else F.col(name) >= F.lit(value)


def field_lte(name: str, value) -> Column | None:
    return None if value is None else F.col(name) <= F.lit(value)


def field_eq(name: str, value) -> Column | None:
    return None if value is None else F.col(name) == F.lit(value)


def block_range(first: int | None, last: int | None, name: str = "block_number") -> Column | None:
    """Inclusive range of heights; an open end has no condition."""
    return all_of([field_gte(name, first), field_lte(name, last)])


def all_of(conditions: Iterable[Column | None]) -> Column | None:
    """Conjunction; None if there is no condition, which stands for every row."""
    present = [c for c in conditions if c is not None]
    return reduce(lambda a, b: a & b, present) if present else None


def any_of(conditions: list[Column | None]) -> Column | None:
    """Disjunction of whole requests: one request without a condition asks for every row."""
    if any(c is None for c in conditions):
        return None
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def where(df: DataFrame, condition: Column | None) -> DataFrame:
    return df if condition is None else df.where(condition)


def where_in(df: DataFrame, name: str, values: list | None) -> DataFrame:
    """As :func:`field_in`, with a semi-join for long lists."""
    if values is None or len(values) <= LONG_LIST:
        return where(df, field_in(name, values))
    wanted = df.sparkSession.createDataFrame([(v,) for v in set(values)], df.select(name).schema)
    return df.join(wanted, name, "left_semi")


def scan(df: DataFrame, requests: list[Column | None], key: list[str], extra: tuple[str, ...] = (), limits: Column | None = None) -> DataFrame:
    """Keys of rows that any request asks for: one pass with one filter, and no columns but the key and those for relations."""
    found = where(where(df, limits), any_of(requests))
    return found.select("block_number", *dict.fromkeys([*key, *extra]))
