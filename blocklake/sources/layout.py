"""The layout of a lake: ``<top>/<first>-<last>-<hash>/<table>.parquet`` with heights of ten digits, and its catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blocklake.sources.shared import stored

CHUNK = r"(\d{10})/(\d{10})-(\d{10})-(\w+)"
CATALOG = "dataset string, top long, first_block long, last_block long, last_hash string, path string"


class MissingData(LookupError):
    """A table or column that a query needs is not in every chunk of its range."""


def listed(spark: SparkSession, pattern: str, files: bool = False) -> list[str]:
    """Paths that fit a pattern, from a listing of names; those of files alone if ``files``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [s.getPath().toString() for s in found if not files or s.isFile()]


def tops_of(spark: SparkSession, root: str, first: int | None = None, last: int | None = None) -> list[str]:
    """Names of the top folders, in order, that may have heights of a range: a top reaches up to where the next one begins."""
    names = sorted(n for n in (p.rpartition("/")[2] for p in listed(spark, f"{root}/*")) if len(n) == 10 and n.isdigit())
    after = [*map(int, names[1:]), None] if names else []  # a lake without chunks has no tops
    return [n for n, end in zip(names, after, strict=True) if (last is None or int(n) <= last) and (first is None or end is None or end >= first)]


def chunk_catalog(spark: SparkSession, root: str, dataset: str = "default", first: int | None = None, last: int | None = None) -> DataFrame:
    """A row for each chunk folder below the tops that a range needs, found by listings of names; nothing in files is read."""
    tops = tops_of(spark, root, first, last)
    names = [(p,) for p in listed(spark, f"{root}/{{{','.join(tops)}}}/*-*-*")] if tops else []
    part = lambda i: F.regexp_extract("path", f"/{CHUNK}$", i)
    rows = spark.createDataFrame(names, "path string").where(F.col("path").rlike(f"/{CHUNK}$"))
    return rows.select(F.lit(dataset).alias("dataset"), part(1).cast("long").alias("top"), part(2).cast("long").alias("first_block"), part(3).cast("long").alias("last_block"), part(4).alias("last_hash"), "path")


def prune_chunks(catalog: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Chunks that share a height with the range."""
    out = catalog if first is None else catalog.where(F.col("last_block") >= first)
    return out if last is None else out.where(F.col("first_block") <= last)


def last_chunk(catalog: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """The latest chunk of each dataset that shares a height with the range."""
    columns = F.struct(*[c for c in catalog.columns if c != "dataset"])
    return prune_chunks(catalog, first, last).groupBy("dataset").agg(F.max_by(columns, "first_block").alias("c")).select("dataset", "c.*")


def chunks_desc(catalog: DataFrame) -> DataFrame:
    return catalog.orderBy(F.desc("first_block"))


def validate_layout(catalog: DataFrame) -> DataFrame:
    """``dataset, first_block, error``: ranges that end before they begin, begin before their top, overlap, or cross the next top."""
    order = Window.partitionBy("dataset").orderBy("first_block", "last_block")
    seen = catalog.withColumn("_before", F.lag("last_block").over(order)).withColumn("_next_top", F.lead("top").over(order))
    errors = F.array_compact(
        F.array(
            F.when(F.col("first_block") > F.col("last_block"), F.lit("end_before_begin")), F.when(F.col("first_block") < F.col("top"), F.lit("before_top")),
            F.when(F.col("first_block") <= F.col("_before"), F.lit("overlap")), F.when((F.col("_next_top") > F.col("top")) & (F.col("last_block") >= F.col("_next_top")), F.lit("crosses_top")),
        )
    )
    return seen.select("dataset", "first_block", F.explode(errors).alias("error"))


def next_block(catalog: DataFrame, start: int = 0) -> DataFrame:
    """The first height that no chunk of a dataset has yet."""
    return catalog.groupBy("dataset").agg((F.coalesce(F.max("last_block") + 1, F.lit(start))).alias("next_block"))


def incomplete_chunks(catalog: DataFrame, files: DataFrame, table: str = "blocks") -> DataFrame:
    """Chunks without the file that is written last; ``files`` has rows ``dataset, first_block, name``."""
    done = files.where(F.col("name").startswith(f"{table}.")).select("dataset", "first_block")
    return catalog.join(done, ["dataset", "first_block"], "left_anti")


def range_conflicts(catalog: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """``dataset, conflict`` where what is stored begins elsewhere than ``first``, or ends after ``last``."""
    ends = catalog.groupBy("dataset").agg(F.min("first_block").alias("lo"), F.max("last_block").alias("hi"))
    end = F.when(F.col("hi") > last, F.lit("ends_after")) if last is not None else F.lit(None).cast("string")
    return ends.select("dataset", F.explode(F.array_compact(F.array(F.when(F.col("lo") != first, F.lit("begins_elsewhere")), end))).alias("conflict"))


def read_table(
    spark: SparkSession, root: str, table: str, first: int | None = None, last: int | None = None, columns: list[str] | None = None,
    within: dict[str, tuple] | None = None, footers: DataFrame | None = None,
) -> DataFrame:
    """A table over all chunks of a range of heights: only their folders are opened; filters and columns reach the scan.

    A table or one of ``columns`` that any chunk of the range lacks is an error before rows are read. ``within``: by column the least
    and greatest value that are wanted (None leaves an end open); chunks whose footers have no such value are not opened.
    ``footers``: what :func:`blocklake.sources.footers.footers` tells of the table, stored once for many reads; else a job reads
    them where ``columns`` or ``within`` ask for them.
    """
    from blocklake.sources import footers as of_files

    paths = [r.path for r in prune_chunks(chunk_catalog(spark, root, first=first, last=last), first, last).select("path").orderBy("path").collect()]  # names
    if not paths:
        raise MissingData(f"no chunk of {root} has heights {first} to {last}")
    tops = {p.split("/")[-2] for p in paths}
    there = {p.rpartition("/")[0] for p in listed(spark, f"{root}/{{{','.join(sorted(tops))}}}/*-*-*/{table}.parquet")}
    missing = [p for p in paths if p not in there]
    if missing:
        raise MissingData(f"table {table} is missing in {len(missing)} chunks, the first is {missing[0]}")
    kept = paths
    if columns or within:
        names = spark.createDataFrame([(p,) for p in paths], "path string")
        if footers is None:
            footers = stored(of_files.footers(spark, root, table, first, last), "footers")
        mine = footers.join(names, "path", "left_semi")
        lacks = of_files.missing_columns(mine, list(dict.fromkeys([*(columns or []), *(within or {})]))).orderBy("path", "column").first()
        if lacks:
            raise MissingData(f"table {table} has no column {lacks['column']} in {lacks['path']}")
        left = names
        for c, (low, high) in (within or {}).items():
            left = left.join(of_files.may_hold(mine, c, low, high), "path", "left_semi")
        kept = [r.path for r in left.orderBy("path").collect()] if within else paths  # names
    df = spark.read.option("mergeSchema", "false").parquet(*[f"{p}/{table}.parquet" for p in kept or paths[:1]])
    height = "number" if table == "blocks" and "number" in df.columns else "block_number"
    bounds = {height: (first, last)} if first is not None or last is not None else {}
    for c, (low, high) in [*bounds.items(), *(within or {}).items()]:
        df = df if low is None else df.where(F.col(c) >= low)
        df = df if high is None else df.where(F.col(c) <= high)
    return df.select(*columns) if columns else df


def dataset_metadata(tables: dict[str, DataFrame]) -> DataFrame:
    """``table, column, type, nullable, nulls``: how many rows have a null there, and whether any has."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
        one = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kind).alias("type"), (F.col(c) > 0).alias("nullable"), F.col(c).alias("nulls")) for c, kind in df.dtypes])
        parts.append(counts.select(F.lit(name).alias("table"), F.explode(one).alias("m")).select("table", "m.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
