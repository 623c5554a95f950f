"""Items grouped by block, and blocks put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collect_items(df: DataFrame, key: list[str], item: Column | str, name: str = "items") -> DataFrame:
    """``block_number`` and the list of its items in order of their key; array keys sort as lists do."""
    item = F.col(item) if isinstance(item, str) else item
    pairs = F.struct(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)]).alias("k"), item.alias("item"))
    if "variant" in df.select(item.alias("i")).dtypes[0][1]:  # which has no order, so keys alone are compared
        ordered = F.array_sort("_all", lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))
    else:
        ordered = F.array_sort("_all")
    return df.groupBy("block_number").agg(F.collect_list(pairs).alias("_all")).select("block_number", F.transform(ordered, lambda x: x["item"]).alias(name))


def assemble_blocks(headers: DataFrame, lists: dict[str, DataFrame], header: Column | None = None) -> DataFrame:
    """``block_number, header`` and one list a kind of item; a block without items of a kind has an empty list.

    Lists have a row a block; all joins are on the height, so one partitioning serves them all.
    """
    out = headers.select(F.col("number").alias("block_number"), (header if header is not None else F.struct(*headers.columns)).alias("header"))
    for name, items in lists.items():
        kind = items.schema[name].dataType.simpleString()
        out = out.join(items.select("block_number", name), "block_number", "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))
    return out


def unnest(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or column, F.explode(column))


def distinct_keys(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(key) if key else df.distinct()


def sort_for_storage(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each partition ascending by keys, nulls last, so that file statistics prune."""
    return df.sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in keys])
