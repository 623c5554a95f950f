"""The footers of a lake's Parquet files as a table: which columns each chunk has, of what type, and between which values."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.sources.layout import chunk_catalog, listed, prune_chunks

SCHEMA = pa.schema([(n, pa.int64() if n in ("rows", "nulls") or n.endswith("_long") else pa.float64() if n.endswith("_double") else pa.string()) for n in (
    "path", "file", "column", "type", "rows", "nulls", "low_long", "high_long", "low_double", "high_double", "low_text", "high_text",
)])
FOOTERS = "path string, file string, column string, type string, rows long, nulls long, low_long long, high_long long, low_double double, high_double double, low_text string, high_text string"
#: Files whose footers one task reads, about.
FILES = 64


def _open(path: str):
    """A Parquet file by its URI: local, or of a store that Arrow knows."""
    from pyarrow import fs
    from pyarrow import parquet as pq

    store, inner = fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))
    return pq.ParquetFile(inner, filesystem=store)


def _ends(kind: pa.DataType, groups: list) -> dict:
    """Least and greatest value over the row groups, as columns of the table; none where a group with values does not tell."""
    if pa.types.is_integer(kind):
        name = "long"
    elif pa.types.is_floating(kind):
        name = "double"
    elif pa.types.is_string(kind) or pa.types.is_large_string(kind):
        name = "text"
    else:
        return {}
    told = [s for rows, s in groups if rows and not (s is not None and s.has_null_count and s.null_count == rows)]
    if not told or any(s is None or not s.has_min_max for s in told):
        return {}
    return {f"low_{name}": min(s.min for s in told), f"high_{name}": max(s.max for s in told)}


def _rows(chunk: str, path: str) -> Iterator[dict]:
    from pyspark.sql.pandas.types import from_arrow_type

    with _open(path) as file:
        meta, schema = file.metadata, file.schema_arrow
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        place = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        for field in schema:
            i = place.get(field.name)  # leaves below a nested column have longer paths
            stats = [] if i is None else [(g.num_rows, g.column(i).statistics) for g in groups]
            known = i is not None and all(s is not None and s.has_null_count for n, s in stats if n)
            nulls = sum(s.null_count for n, s in stats if n) if known else None
            yield {"path": chunk, "file": path, "column": field.name, "type": from_arrow_type(field.type).simpleString(), "rows": meta.num_rows, "nulls": nulls} | _ends(field.type, stats)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, path in zip(batch["path"].to_pylist(), batch["file"].to_pylist(), strict=True):
            yield pa.RecordBatch.from_pylist(list(_rows(chunk, path)), SCHEMA)


def footers(spark: SparkSession, root: str, table: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """A row for each file of a table and column in it, over all chunks of a range of heights; tasks read footers, no data.

    ``path`` (the chunk's folder), ``file, column, type, rows, nulls`` and the least and greatest value, as long, double or text by
    the column's type. ``nulls`` is null for nested columns and where a file does not tell; ends are null for other types, for
    columns without values, and where a file has no statistics of them. Chunks without the table have no row; a lake
    without chunks gives an empty table. Files are opened by Arrow, so their store must be one that it knows (local, HDFS, S3, GCS).
    """
    paths = [r.path for r in prune_chunks(chunk_catalog(spark, root, first=first, last=last), first, last).select("path").orderBy("path").collect()]  # names
    tops = sorted({p.split("/")[-2] for p in paths})
    wanted, files = set(paths), []
    if tops:
        for pattern, depth in ((f"{table}.parquet/*.parquet", 2), (f"{table}.parquet", 1)):
            for name in listed(spark, f"{root}/{{{','.join(tops)}}}/*-*-*/{pattern}", files=True):
                chunk = name.rsplit("/", depth)[0]
                if chunk in wanted:
                    files.append((chunk, name))
    names = spark.createDataFrame(files, "path string, file string")
    return names.repartition(max(1, -(-len(files) // FILES)), "file").mapInArrow(_read, FOOTERS)


def columns_of_chunks(found: DataFrame) -> DataFrame:
    """``path, column, type, rows, nulls`` and ends of :func:`footers`, a row a chunk and column; files of one chunk are put together.

    ``type`` is that of the last file by name if they differ, and ``rows`` and ``nulls`` count all of them; ends are null where a file with
    values does not tell.
    """
    told = (F.col("nulls") == F.col("rows")) | (F.col("rows") == 0)
    ends = []
    for kind in ("long", "double", "text"):
        low, high = f"low_{kind}", f"high_{kind}"
        silent = F.max(F.col(low).isNull() & ~F.coalesce(told, F.lit(False)))
        ends += [F.when(~silent, F.min(low)).alias(low), F.when(~silent, F.max(high)).alias(high)]
    nulls = F.when(F.count("nulls") == F.count("*"), F.sum("nulls")).alias("nulls")
    return found.groupBy("path", "column").agg(F.max_by("type", "file").alias("type"), F.sum("rows").alias("rows"), nulls, *ends)


def missing_columns(found: DataFrame, columns: list[str]) -> DataFrame:
    """``path, column`` of the columns that a file of a chunk lacks."""
    have = found.where(F.col("column").isin(columns)).groupBy("path", "column").agg(F.count_distinct("file").alias("n"))
    each = F.explode(F.array(*[F.lit(c) for c in columns]).cast("array<string>")).alias("column")
    wanted = found.groupBy("path").agg(F.count_distinct("file").alias("files")).select("path", "files", each)
    return wanted.join(have, ["path", "column"], "left").where(F.coalesce("n", F.lit(0)) < F.col("files")).select("path", "column")


def may_hold(found: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """``path`` of the chunks that may have a value of ``column`` from ``low`` to ``high`` (both included; None leaves an end open).

    A chunk goes only if its footers say so: all its values lie outside, or it has none. A chunk of which they say nothing stays,
    and so does one that lacks the column.
    """
    kinds = ("text",) if isinstance(low if low is not None else high, str) else ("long", "double")  # a column has one of them
    out = F.coalesce(*[_outside(F.col(f"low_{k}"), F.col(f"high_{k}"), low, high) for k in kinds], F.lit(False))
    empty = F.coalesce(F.col("nulls") == F.col("rows"), F.lit(False))
    return columns_of_chunks(found).groupBy("path").agg(F.max(F.when(F.col("column") == column, out | empty)).alias("gone")).where(~F.coalesce("gone", F.lit(False))).select("path")


def _outside(least: Column, most: Column, low, high) -> Column:
    """Whether all values lie outside; null where the ends are not known."""
    below = most < F.lit(low) if low is not None else F.lit(False)
    above = least > F.lit(high) if high is not None else F.lit(False)
    return F.when(least.isNotNull(), below | above)


def metadata(tables: dict[str, DataFrame]) -> DataFrame:
    """``table, column, type, nullable, nulls`` like :func:`layout.dataset_metadata`, from footers alone, no row read.

    ``nulls`` and ``nullable`` are null where a file does not tell (nested columns). A column that some file lacks is null in all of its rows.
    """
    parts = []
    for name, found in tables.items():
        files = found.groupBy("file").agg(F.first("rows").alias("rows")).agg(F.sum("rows").alias("all_rows"))
        one = found.groupBy("column").agg(F.max_by("type", "file").alias("type"), F.sum("rows").alias("rows"), F.when(F.count("nulls") == F.count("*"), F.sum("nulls")).alias("nulls"))
        parts.append(one.join(F.broadcast(files)).select(F.lit(name).alias("table"), "column", "type", (F.col("nulls") + F.col("all_rows") - F.col("rows")).alias("nulls")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table", "column", "type", (F.col("nulls") > 0).alias("nullable"), "nulls")
