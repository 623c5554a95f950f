"""Sharding by size-tiered compaction with a versioned manifest.

Arrivals are appended as they come: each task writes its rows as a small immutable shard, with no shuffle. Compaction
takes shards of one size tier together into files near the target size, with one shuffle of just those rows. Each step
ends with a new manifest, a table of the live shards, written under a name of its own and then renamed to its version's: a
version is there whole or not at all, and of two writers of one version only one can rename. Readers see one version or the
next, and old shards stay until they are vacuumed. The rename must be atomic, as it is on HDFS and local disks.

The manifest is a table; only its sums come to the driver, and names of what a reader opens: of at most MOST_SENT shards, or of
the folders of appends and compactions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blocklake.llm.common import shared_dir, spare, stored, table

TARGET_BYTES, TIER_BASE = 64 << 20, 4
#: Up to so many shards are sent to all tasks as a lookup; more are joined by a shuffle.
MOST_SENT = 50_000
#: ``shard`` is a path below the root, ``folder`` what a reader of that shard alone opens.
MANIFEST = "shard string, folder string, merged boolean, n_docs long, n_bytes long"
#: How often a commit is tried again on top of what others have committed meanwhile.
TRIES = 8


class CommitConflict(RuntimeError):
    """Another writer committed this version first; nothing of ours is visible."""


def _fs(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, root: str) -> list[int]:
    """All committed versions, in order: a number each."""
    fs, path = _fs(spark, root)
    return sorted(int(s.getPath().getName()[2:]) for s in fs.globStatus(path(f"{root}/manifests/v-*")) or [])


def current_version(spark: SparkSession, root: str) -> int:
    """The last committed version; 0 if there is none."""
    return max(versions(spark, root), default=0)


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The live shards of a version: ``shard``, ``folder``, ``merged``, ``n_docs``, ``n_bytes`` (of texts)."""
    version = current_version(spark, root) if version is None else version
    if not version:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/v-{version:09d}")


def commit(spark: SparkSession, root: str, entries: DataFrame, version: int) -> int:
    """Makes ``entries`` the live shards as of ``version``, or raises CommitConflict and changes nothing."""
    name = f"{root}/manifests/new-{uuid.uuid4().hex}"
    entries.write.parquet(name)
    fs, path = _fs(spark, root)
    jvm, to = spark._jvm, f"{root}/manifests/v-{version:09d}"
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE  # an existing name is an error
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(path(root)).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(path(name)), fs.makeQualified(path(to)), options)
    except Exception as e:
        fs.delete(path(name), True)
        if fs.exists(path(to)):
            raise CommitConflict(f"version {version} of {root} is there already") from e
        raise
    return version


def _commit_on_top(spark: SparkSession, root: str, change) -> int:
    """Commits ``change(live shards)`` as the next version, again on top of what others commit meanwhile."""
    for k in range(TRIES):
        version = current_version(spark, root)
        try:
            return commit(spark, root, change(manifest(spark, root, version)), version + 1)
        except CommitConflict:
            if k + 1 == TRIES:
                raise
    raise AssertionError


def _shard(file_path: Column) -> Column:
    """The path below the root of the shard that a file is (an arrival) or is in (a merged one)."""
    below = F.concat(F.lit("data/"), F.element_at(F.split(file_path, "/data/"), -1))
    return F.regexp_replace(below, r"^(data/[^/]+/[^/]+)/[^/]+$", "$1")


def _read(spark: SparkSession, root: str, folders: list[str], schema, name: str) -> DataFrame:
    """All rows of the files below ``folders``, with their shard as ``name``."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f"{root}/{f}" for f in folders]).withColumn(name, _shard(F.col("_metadata.file_path")))


def _rows_of(spark: SparkSession, root: str, shards: DataFrame, schema, name: str) -> DataFrame:
    """The rows of ``shards`` with their shard as ``name``: up to MOST_SENT of them are opened by their paths, more by their folders and a join."""
    few = [r["shard"] for r in shards.select("shard").limit(MOST_SENT + 1).collect()]
    if not few:
        return spark.createDataFrame([], schema).drop(name).withColumn(name, F.lit(None).cast("string"))
    if len(few) <= MOST_SENT:
        return _read(spark, root, few, schema, name)
    folders = [r["folder"] for r in shards.select("folder").distinct().collect()]  # one for each append, and merged ones
    return _read(spark, root, folders, schema, name).join(shards.select(F.col("shard").alias(name)), name, "left_semi")


def append(docs: DataFrame, root: str, text: str = "text") -> int:
    """Writes arrivals as small shards and commits them; returns the version. Every row and column is kept as it is.

    Empty arrivals make a version with no new shards. What other writers commit meanwhile stays.
    """
    spark = docs.sparkSession
    name = f"data/run-{uuid.uuid4().hex}"
    docs.write.option("compression", "zstd").parquet(f"{root}/{name}")
    shard, size = spare(docs.columns, "shard", "size")
    files = _read(spark, root, [name], docs.schema, shard).select(F.col(shard).alias("shard"), F.octet_length(text).alias("size"))
    new = files.groupBy("shard").agg(F.lit(name).alias("folder"), F.lit(False).alias("merged"), F.count("*").alias("n_docs"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("n_bytes"))
    new = stored(new, "arrivals")
    try:
        return _commit_on_top(spark, root, lambda live: live.unionByName(new))
    except CommitConflict:
        fs, of = _fs(spark, root)
        fs.delete(of(f"{root}/{name}"), True)
        raise


def plan_merges(entries: DataFrame, target: int = TARGET_BYTES, base: int = TIER_BASE) -> DataFrame:
    """``entries`` with ``tier`` and ``run``: shards of one ``run`` go into one file; null stays as it is.

    A tier holds sizes within a factor of ``base``. In a tier shards are taken in order of size until the target is full; a
    shard of half the target or more is done, and so is one that would be alone. Tiers are cut into stretches by a hash of
    the name, so that no task orders all shards of a lake.
    """
    shards = entries.agg(F.count("*")).first()[0]
    small = F.col("n_bytes") * 2 < target
    tier = F.when(small, F.floor(F.log(float(base), F.greatest(F.col("n_bytes"), F.lit(1)).cast("double"))).cast("int"))
    stretch = F.pmod(F.xxhash64("shard"), F.lit(1 + shards // MOST_SENT))
    by_size = Window.partitionBy("tier", "stretch").orderBy("n_bytes", "shard").rowsBetween(Window.unboundedPreceding, -1)
    cut = entries.withColumn("tier", tier).withColumn("stretch", stretch).withColumn("part", F.floor(F.coalesce(F.sum("n_bytes").over(by_size), F.lit(0)) / target))
    members = F.count("*").over(Window.partitionBy("tier", "stretch", "part"))
    run = F.when(small & (members > 1), F.concat_ws("-", "tier", "stretch", "part"))
    return cut.withColumn("run", run).drop("stretch", "part")


def compact(spark: SparkSession, root: str, schema, target: int = TARGET_BYTES, base: int = TIER_BASE) -> int:
    """Merges shards of similar size into files near ``target`` bytes of text and commits; returns the live version.

    With nothing to merge the version stays. A run is at most about one target above the target, one file, one task. What
    others append meanwhile stays; if they merged the same shards, CommitConflict is raised and our files go.
    """
    version = current_version(spark, root)
    plan = stored(plan_merges(manifest(spark, root, version), target, base), "merge-plan")
    moving = plan.where("run is not null")
    n = moving.count()
    if not n:
        return version
    name = f"data/run-{uuid.uuid4().hex}"
    shard, run = spare([f.name for f in schema.fields], "shard", "run")
    lookup = moving.select(F.col("shard").alias(shard), F.col("run").alias(run))
    lookup = F.broadcast(lookup) if n <= MOST_SENT else lookup
    rows = _rows_of(spark, root, moving, schema, shard)
    rows.join(lookup, shard).drop(shard).repartition(run).write.partitionBy(run).option("compression", "zstd").parquet(f"{root}/{name}")
    path = F.concat(F.lit(f"{name}/{run}="), "run")
    merged = moving.groupBy("run").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_bytes").alias("n_bytes")).select(path.alias("shard"), path.alias("folder"), F.lit(True).alias("merged"), "n_docs", "n_bytes")

    def change(live: DataFrame) -> DataFrame:
        if not moving.join(live, "shard", "left_anti").isEmpty():
            raise CommitConflict(f"shards of {root} were merged by another writer")
        return live.join(moving.select("shard"), "shard", "left_anti").select(*live.columns).unionByName(merged)

    try:
        return _commit_on_top(spark, root, change)
    except CommitConflict:
        fs, of = _fs(spark, root)
        fs.delete(of(f"{root}/{name}"), True)
        raise


def read_shards(spark: SparkSession, root: str, schema, version: int | None = None, name: str = "shard") -> DataFrame:
    """All rows of a version, with the shard that holds each as ``name``, a path below the root (replacing such a column)."""
    # many merged shards of one compaction share its folder
    live = manifest(spark, root, version).withColumn("folder", F.regexp_extract("shard", "^data/[^/]+", 0))
    return _rows_of(spark, root, live, schema, name)


def vacuum(spark: SparkSession, root: str, keep: int | None = None) -> int:
    """Deletes shards that no version from ``keep`` (default: the current one) on holds; returns how many."""
    every = versions(spark, root)
    keep = max(every, default=0) if keep is None else keep
    shards = lambda vs: [manifest(spark, root, v).select("shard") for v in vs]
    old, live = shards([v for v in every if v < keep]), shards([v for v in every if v >= keep])
    if not old or not live:
        return 0
    union = lambda dfs: dfs[0] if len(dfs) == 1 else dfs[0].unionByName(union(dfs[1:]))
    fs, path = _fs(spark, root)
    dead = union(old).distinct().join(union(live), "shard", "left_anti")
    return sum(bool(fs.delete(path(f"{root}/{r['shard']}"), True)) for r in dead.toLocalIterator())  # name after name


def shard(docs: DataFrame, root: str | None = None, target: int = TARGET_BYTES, text: str = "text", names: tuple[str, str] = ("shard", "version")) -> DataFrame:
    """Appends ``docs`` to the shards at ``root`` (a new place in the shared folder if None), compacts, and reads the result.

    All rows and columns are kept, repeated and null ones too, with each row's shard and the version added under ``names``
    (such columns of ``docs`` are replaced); null texts count no bytes; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    docs = docs.drop(*names)
    root = root or f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    append(docs, root, text)
    version = compact(spark, root, docs.schema, target)
    return read_shards(spark, root, docs.schema, version, names[0]).withColumn(names[1], F.lit(version).cast("int"))


def with_totals(sharded: DataFrame, shard: str, totals: dict[str, Column]) -> DataFrame:
    """``sharded`` with ``totals`` of each row's shard, summed by task first and sent to all tasks while they are few."""
    sums = stored(sharded.groupBy(shard).agg(*[c.alias(k) for k, c in totals.items()]), "shard-totals")
    return sharded.join(F.broadcast(sums) if sums.count() <= MOST_SENT else sums, shard)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the shard that each is in after compaction: its number, rows and bytes."""
    sharded = shard(table(spark, sf_dir, "documents")).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "shard", "version")
    # a shard is known by the least id in it: names are new in every run
    out = with_totals(sharded, "shard", {"shard_id": F.min("doc_id"), "shard_docs": F.count("*"), "shard_bytes": F.sum("n_bytes")})
    return out.select("doc_id", "n_bytes", "shard_id", "shard_docs", "shard_bytes", "version")


QUERIES = {"op7_sharding": query}
SQL: dict[str, str] = {}
