"""Checks of a lake: each gives ``check, block_number, key, expected, actual`` for what is wrong; no rows, nothing wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blocklake.functions.codecs import keccak_bytes


def _report(df: DataFrame, check: str, block: Column, key: Column, expected: Column, actual: Column) -> DataFrame:
    text = lambda c: c.cast("string")
    return df.select(F.lit(check).alias("check"), block.cast("long").alias("block_number"), text(key).alias("key"), text(expected).alias("expected"), text(actual).alias("actual"))


def short_hash(c: Column, rule: str = "last5") -> Column:
    """The part of a hash that names chunks: ``first8`` hex digits after 0x, ``last5``, or ``strip16`` (the first 16 signs off)."""
    return {"first8": F.substring(c, 3, 8), "last5": F.right(c, F.lit(5)), "strip16": F.substring(c, 17, 1 << 20), "full": c}[rule]


def audit_continuity(blocks: DataFrame, rule: str = "last5", bucket: int = 100_000) -> DataFrame:
    """Blocks whose parent hash is not the hash of the block before. Buckets of heights by themselves, then across their edges."""
    rows = blocks.select("number", short_hash(F.col("hash"), rule).alias("hash"), short_hash(F.col("parent_hash"), rule).alias("parent_hash")).withColumn("_bucket", F.floor(F.col("number") / bucket))
    order = Window.partitionBy("_bucket").orderBy("number")
    inner = rows.withColumn("before", F.lag("hash").over(order)).withColumn("first", F.row_number().over(order) == 1)
    last = rows.groupBy("_bucket").agg(F.max_by("hash", "number").alias("hash"))
    edge = last.select("_bucket", F.lag("hash").over(Window.partitionBy(F.lit(0)).orderBy("_bucket")).alias("edge"))  # a row a bucket
    seen = inner.join(edge, "_bucket").withColumn("before", F.when(F.col("first"), F.col("edge")).otherwise(F.col("before")))
    return _report(seen.where("before is not null and not (parent_hash <=> before)"), "continuity", F.col("number"), F.col("number"), F.col("before"), F.col("parent_hash"))


def audit_links(children: DataFrame, parents: DataFrame, on: list[str], check: str = "link") -> DataFrame:
    """Children without a parent of their block and key."""
    orphans = children.join(parents.select("block_number", *on), ["block_number", *on], "left_anti")
    return _report(orphans, check, F.col("block_number"), F.concat_ws("-", *on), F.lit("parent"), F.lit(None))


def audit_log_links(logs: DataFrame, transactions: DataFrame) -> DataFrame:
    """Logs whose transaction hash is not that of the transaction at their index, or that have none."""
    tx = transactions.select("block_number", "transaction_index", F.col("hash").alias("_h"))
    met = logs.join(tx, ["block_number", "transaction_index"], "left").where(~F.col("transaction_hash").eqNullSafe(F.col("_h")))
    return _report(met, "log_link", F.col("block_number"), F.concat_ws("-", "transaction_index", "log_index"), F.col("_h"), F.col("transaction_hash"))


def audit_missing(df: DataFrame, column: str, key: str) -> DataFrame:
    """Rows without a value that all should have."""
    return _report(df.where(F.col(column).isNull()), f"missing_{column}", F.col("block_number"), F.col(key), F.lit(column), F.lit(None))


def audit_duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys with more than one row."""
    many = df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    block = F.col("block_number") if "block_number" in key else F.lit(None)
    return _report(many, "duplicate", block, F.concat_ws("-", *[k for k in key if k != "block_number"]), F.lit(1), F.col("n"))


def audit_counts(headers: DataFrame, rows: DataFrame, declared: str) -> DataFrame:
    """Blocks whose declared number of rows is not what is there."""
    counted = rows.groupBy("block_number").agg(F.count("*").alias("n"))
    met = headers.join(counted, headers["number"] == counted["block_number"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return _report(met.where(F.col("n") != F.col(declared)), "count", F.col("number"), F.lit(declared), F.col(declared), F.col("n"))


def logs_bloom(logs: DataFrame) -> DataFrame:
    """``block_number, bloom``: 2048-bit filters as hex, of each block's log addresses and topics.

    Each entry is hashed once, gives three bits, and bits are put together by byte; a block's filter has 256 bytes.
    """
    entries = logs.select("block_number", F.explode(F.array_compact(F.array("address", "topic0", "topic1", "topic2", "topic3"))).alias("e")).distinct()
    hashed = entries.withColumn("h", F.hex(keccak_bytes(F.unhex(F.substring("e", 3, 64)))))
    bit = lambda i: F.conv(F.substring("h", 4 * i + 1, 4), 16, 10).cast("int").bitwiseAND(2047)
    bits = hashed.select("block_number", F.explode(F.array(*[bit(i) for i in range(3)])).alias("bit")).distinct()
    by_byte = bits.groupBy("block_number", F.floor((2047 - F.col("bit")) / 8).cast("int").alias("byte")).agg(F.expr("bit_or(shiftleft(1, bit % 8))").alias("v"))
    maps = by_byte.groupBy("block_number").agg(F.map_from_entries(F.collect_list(F.struct("byte", "v"))).alias("m"))
    digits = F.transform(F.sequence(F.lit(0), F.lit(255)), lambda i: F.lpad(F.lower(F.hex(F.coalesce(F.try_element_at("m", i), F.lit(0)))), 2, "0"))
    return maps.select("block_number", F.concat(F.lit("0x"), F.array_join(digits, "")).alias("bloom"))


def audit_logs_bloom(headers: DataFrame, logs: DataFrame) -> DataFrame:
    """Blocks whose header filter is not the one of their logs."""
    own = logs_bloom(logs)
    met = headers.join(own, headers["number"] == own["block_number"], "left").withColumn("bloom", F.coalesce("bloom", F.lit("0x" + "0" * 512)))
    return _report(met.where(F.col("bloom") != F.lower("logs_bloom")), "logs_bloom", F.col("number"), F.lit("bloom"), F.col("bloom"), F.col("logs_bloom"))
