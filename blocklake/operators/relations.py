"""Relations between selected rows: parents, children, exact addresses, subtrees, stacks, siblings.

Every relation is a hash-able equi-join. Tree relations expand one side to the prefixes of its addresses (rows x depth) and
compare addresses for equality, so a hot transaction never meets itself in a nested loop. Item tables are only ever
semi-joined: no relation repeats an item. Nulls in keys match nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _semi(items: DataFrame, keys: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Items with a partner in ``keys``; ``on`` has pairs (item column, key column)."""
    renamed = keys.select(*[F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(on)])
    return items.join(renamed, reduce(lambda a, b: a & b, [items[a] == F.col(f"_k{i}") for i, (a, _) in enumerate(on)]), "left_semi")


def scan_keys(scan: DataFrame, key: list[str]) -> DataFrame:
    """The scanned rows themselves."""
    return scan.select("block_number", *key)


def ref_parent(scan: DataFrame, columns: list[str], item_key: list[str]) -> DataFrame:
    """Keys of the parents that scanned rows point to: reference columns under the names of the parent's key."""
    present = [F.col(c).isNotNull() for c in columns]
    return scan.where(reduce(lambda a, b: a & b, present)).select("block_number", *[F.col(c).alias(k) for c, k in zip(columns, item_key, strict=True)])


def join_children(items: DataFrame, scan: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Items that share block and ``on`` (item column, scan column) with a scanned row."""
    return _semi(items, scan, [("block_number", "block_number"), *on])


def join_same_parent(items: DataFrame, scan: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Other items of the same parent as a scanned row, itself included."""
    return join_children(items, scan, on)


def join_at(items: DataFrame, scan: DataFrame, on: list[tuple[str, str]], address: tuple[str, str]) -> DataFrame:
    """Items at exactly the address of a scanned node."""
    return join_children(items, scan, [*on, address])


def prefixes(address: Column, include_self: bool) -> Column:
    """All prefixes of an address from the empty one on; none for null."""
    size = F.size(address) - (0 if include_self else 1)
    return F.when(size >= 0, F.transform(F.sequence(F.lit(0), F.greatest(size, F.lit(0))), lambda n: F.slice(address, F.lit(1), n)))


def descendants(items: DataFrame, scan: DataFrame, on: list[tuple[str, str]], address: tuple[str, str], include_self: bool = False) -> DataFrame:
    """Items below a scanned node, or also at it: one of an item's own prefixes is a scanned address."""
    key = [c for c, _ in on]
    expanded = items.select("block_number", *key, F.col(address[0]).alias("_own"), F.explode(prefixes(F.col(address[0]), include_self)).alias("_prefix"))
    below = _semi(expanded, scan, [("block_number", "block_number"), *on, ("_prefix", address[1])])
    found = below.select("block_number", *key, "_own").distinct()
    return _semi(items, found, [("block_number", "block_number"), *[(c, c) for c in key], (address[0], "_own")])


def subtree(items: DataFrame, scan: DataFrame, on: list[tuple[str, str]], address: tuple[str, str]) -> DataFrame:
    """Strict descendants of scanned nodes; a scan of a root takes all others of its group."""
    return descendants(items, scan, on, address)


def ancestors(items: DataFrame, scan: DataFrame, on: list[tuple[str, str]], address: tuple[str, str], include_self: bool = False) -> DataFrame:
    """Items above a scanned node, or also at it: the item's address is a prefix of a scanned one."""
    up = scan.select("block_number", *dict.fromkeys(b for _, b in on), F.explode(prefixes(F.col(address[1]), include_self)).alias("_prefix"))
    return _semi(items, up, [("block_number", "block_number"), *on, (address[0], "_prefix")])


def siblings(items: DataFrame, scan: DataFrame, on: list[tuple[str, str]], address: tuple[str, str], same_parent: bool = False) -> DataFrame:
    """Items of the same group at the same depth as a scanned node, itself included; only under its parent if asked."""
    place = (lambda c: F.slice(F.col(c), F.lit(1), F.greatest(F.size(c) - 1, F.lit(0)))) if same_parent else (lambda c: F.size(c))
    deep = items.withColumn("_depth", F.size(address[0])).withColumn("_place", place(address[0]))
    near = scan.where(F.col(address[1]).isNotNull()).withColumn("_depth", F.size(address[1])).withColumn("_place", place(address[1]))
    return _semi(deep, near, [("block_number", "block_number"), *on, ("_depth", "_depth"), ("_place", "_place")]).drop("_depth", "_place")


def union_keys(sources: list[DataFrame]) -> DataFrame:
    """All key tables as one; copies stay, since a semi-join does not mind them."""
    return reduce(DataFrame.unionByName, sources)


def select_items(items: DataFrame, sources: list[DataFrame], key: list[str]) -> DataFrame:
    """Rows of the item table with a key in any source, each once."""
    return _semi(items, union_keys([s.select("block_number", *key) for s in sources]), [("block_number", "block_number"), *[(k, k) for k in key]])


def attach_receipts(transactions: DataFrame, receipts: DataFrame, hash: str = "hash", receipt_hash: str = "transaction_hash") -> DataFrame:
    """Every transaction with its receipt's columns, or nulls where there is none."""
    own = receipts.withColumnRenamed(receipt_hash, "_h")
    return transactions.join(own, transactions[hash] == F.col("_h"), "left").drop("_h")


def assign_replays(transactions: DataFrame, replays: DataFrame, on: str = "hash") -> tuple[DataFrame, DataFrame]:
    """Transactions with their replay, and the replays that no transaction has."""
    return transactions.join(replays, on, "left"), replays.join(transactions.select(on), on, "left_anti")
