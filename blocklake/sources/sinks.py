"""Readers of raw blocks, and writers of tables, raw chunks and results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.functions.codecs import sha3_bytes
from blocklake.functions.project import byte_size
from blocklake.operators.assemble import sort_for_storage
from blocklake.operators.budget import assign_chunks, roll
from blocklake.operators.ingest import add_sizes
from blocklake.plans.specs import TableSpec


def read_raw_blocks(spark: SparkSession, root: str, schema, first: int | None = None, last: int | None = None, number: str = "number") -> DataFrame:
    """Lines of (gzip) JSON files below ``root``, a block each, within a range of heights."""
    df = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*").json(root)
    df = df if first is None else df.where(F.col(number) >= first)
    return df if last is None else df.where(F.col(number) <= last)


def file_options(columns: list[str], rows: int | None = None, dictionary: list[str] | None = None, statistics: list[str] | None = None) -> dict[str, str]:
    """Options of the Parquet writer: rows of a row group, columns with a dictionary (all if None), and with statistics."""
    out = {"compression": "zstd", "parquet.page.size": str(128 << 10), "parquet.dictionary.page.size": str(128 << 10)}
    if rows:
        out["parquet.block.row.count.limit"] = str(rows)
    if dictionary is not None:
        out |= {"parquet.enable.dictionary": "false"} | {f"parquet.enable.dictionary#{c}": "true" for c in dictionary if c in columns}
    if statistics is not None:
        out |= {f"parquet.column.statistics.enabled#{c}": "true" if c in statistics else "false" for c in columns}
    return out


def write_tables(tables: dict[str, DataFrame], specs: dict[str, TableSpec], dest: str, chunk: str = "chunk", rules: dict | None = None) -> None:
    """Each table below ``dest``, a folder a chunk, rows in storage order so that statistics prune, zstd.

    ``rules``: by table what a :class:`blocklake.plans.tables.TableRule` says of its files: rows of a row group, columns with a
    dictionary and with statistics, columns whose bytes are measured (``<column>_size``); tables but that of blocks also get ``_idx``, a
    row's place in its file.
    """
    for name, df in tables.items():
        spec, rule = specs.get(name, TableSpec(name)), (rules or {}).get(name)
        height = ["block_number"] if "block_number" in df.columns else ["number"]
        keys = [k for k in dict.fromkeys([*spec.sort, *height, *spec.key]) if k in df.columns]
        options = file_options(df.columns)
        if rule is not None:
            df = df.withColumns({f"{c}_size": byte_size(F.col(c)) for c in rule.sizes.split()})
            if name != "blocks":
                df = add_sizes(df, [], keys, chunk)
            options = file_options(df.columns, rule.rows, rule.dictionary.split(), rule.statistics.split())
        ordered = sort_for_storage(df.repartition(chunk), [chunk, *keys])
        ordered.write.partitionBy(chunk).options(**options).parquet(f"{dest}/{name}")


def write_lake(tables: dict[str, DataFrame], specs: dict[str, TableSpec], chunks: DataFrame, root: str, last_table: str = "blocks", rules: dict | None = None) -> None:
    """Tables in the layout that :func:`layout.read_table` reads, a folder for each of ``chunks``.

    ``chunks``: rows ``chunk, top, first_block, last_block, last_hash``; each table has a ``chunk`` column. Everything is written aside
    first, with an empty file for a chunk that has no rows of a table; then each chunk's folder is put together there and
    moved to its place by one rename, so that a chunk is there whole or not at all. A chunk that is there already stays.
    """
    spark = chunks.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    aside = f"{root}/_new-{uuid.uuid4().hex}"
    write_tables(tables, specs, aside, rules=rules)
    for name, df in tables.items():  # one small job a table: the schema with no rows
        df.drop("chunk").limit(0).coalesce(1).write.parquet(f"{aside}/_none/{name}")
    util, conf = spark._jvm.org.apache.hadoop.fs.FileUtil, spark._jsc.hadoopConfiguration()
    for r in chunks.select("chunk", "top", "first_block", "last_block", "last_hash").toLocalIterator():  # names
        whole, folder = path(f"{aside}/_whole/{r.chunk}"), path(f"{root}/{r.top:010d}/{r.first_block:010d}-{r.last_block:010d}-{r.last_hash}")
        if fs.exists(folder):
            continue
        fs.mkdirs(whole)
        for name in sorted(tables, key=lambda n: n == last_table):
            source = path(f"{aside}/{name}/chunk={r.chunk}")
            if fs.exists(source):
                fs.rename(source, path(f"{whole}/{name}.parquet"))
            else:
                util.copy(fs, path(f"{aside}/_none/{name}"), fs, path(f"{whole}/{name}.parquet"), False, conf)
        fs.mkdirs(folder.getParent())
        fs.rename(whole, folder)
    fs.delete(path(aside), True)


def write_raw(blocks: DataFrame, dest: str, chunk: str | None = None, chunk_mb: int = 1024) -> None:
    """Raw blocks as gzip JSON lines, a folder a chunk: by the column ``chunk``, or by about ``chunk_mb`` megabytes of JSON each."""
    if chunk is None:
        chunk = "chunk"
        sized = blocks.withColumns({"block_number": F.col("number"), "size": F.octet_length(F.to_json(F.struct(*blocks.columns)))})
        blocks = assign_chunks(sized, chunk_mb << 20).drop("block_number", "size")
    blocks.repartition(chunk).sortWithinPartitions(chunk, "number").write.partitionBy(chunk).option("compression", "gzip").json(dest)


def write_blocks(result: DataFrame, dest: str) -> None:
    """Blocks of a result (``block_number, value``) as gzip JSON lines in order of height."""
    result.repartitionByRange("block_number").sortWithinPartitions("block_number").select("value").write.option("compression", "gzip").text(dest)


def page_digests(pages: DataFrame) -> DataFrame:
    """``chunk, page, sha256`` of the JSON texts (``value``) of each page, joined in order of height; a page has bounded bytes."""
    ordered = F.array_sort(F.collect_list(F.struct("block_number", "value")))
    return pages.groupBy("chunk", "page").agg(ordered.alias("b")).select("chunk", "page", F.sha2(F.array_join(F.transform("b", lambda x: x["value"]), "\n"), 256).alias("sha256"))


def result_pages(result: DataFrame, page_bytes: int, size: str | None = None) -> DataFrame:
    """``page, first_block, last_block, blocks, body, sha3``: a result (``block_number, value``) as pages to be delivered.

    A page ends with the block at which its bytes exceed ``page_bytes``; ``body`` is a JSON array of its blocks in order of height,
    ``sha3`` the SHA3-256 of the body in hex, and ``last_block`` what the next request begins after. Exact over any number of blocks;
    a page has bounded bytes but for its last block. No blocks give no pages.
    """
    sized = result.select("block_number", "value", (F.col(size) if size else F.octet_length("value")).cast("long").alias("size"))
    paged = roll(sized, page_bytes, name="page")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("block_number", "value"))), lambda x: x["value"])
    bodies = paged.groupBy("page").agg(F.min("block_number").alias("first_block"), F.max("block_number").alias("last_block"), F.count("*").alias("blocks"), F.concat(F.lit("["), F.array_join(ordered, ","), F.lit("]")).alias("body"))
    return bodies.withColumn("sha3", F.lower(F.hex(sha3_bytes(F.encode("body", "UTF-8")))))


def write_pages(pages: DataFrame, dest: str) -> None:
    """Each page's body as gzip text in a folder ``page=<n>``, and the cursor table (all but the bodies) beside them in ``pages``."""
    pages.select("page", "body").repartition("page").write.partitionBy("page").option("compression", "gzip").text(f"{dest}/bodies")
    pages.drop("body").write.parquet(f"{dest}/pages")
