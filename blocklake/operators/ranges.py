"""Algebra of inclusive height ranges ``dataset, beg, end``: a row a chunk or a gap, not a row a block. Windows are by dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_ranges(df: DataFrame) -> DataFrame:
    """Ranges that overlap or touch (the next begins at the end plus one) become one."""
    order = Window.partitionBy("dataset").orderBy("beg", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_new", F.when(reach.isNull() | (F.col("beg") > reach + 1), 1).otherwise(0))
    islands = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("dataset", "_island").agg(F.min("beg").alias("beg"), F.max("end").alias("end")).drop("_island")


def subtract_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """Heights of ``a`` that are not in ``b``, as merged ranges: a sweep over the edges of both."""

    def edges(df: DataFrame, side: str) -> DataFrame:
        other = "b" if side == "a" else "a"
        ends = F.array(F.struct(F.col("beg").alias("at"), F.lit(1).alias("d")), F.struct((F.col("end") + 1).alias("at"), F.lit(-1).alias("d")))
        return merge_ranges(df).select("dataset", F.explode(ends).alias("e")).select("dataset", "e.at", F.col("e.d").alias(side), F.lit(0).alias(other))

    at = edges(a, "a").unionByName(edges(b, "b")).groupBy("dataset", "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    order = Window.partitionBy("dataset").orderBy("at")
    swept = at.select("dataset", F.col("at").alias("beg"), (F.lead("at").over(order) - 1).alias("end"), F.sum("a").over(order).alias("_a"), F.sum("b").over(order).alias("_b"))
    return merge_ranges(swept.where("_a > 0 and _b = 0 and end is not null").select("dataset", "beg", "end"))


def intersect_ranges(a: DataFrame, b: DataFrame, width: int = 1 << 16) -> DataFrame:
    """Heights in both, as merged ranges. Ranges meet by bins of the axis, so the join has an equal key."""
    bins = lambda beg, end: F.explode(F.sequence(F.floor(F.col(beg) / width), F.floor(F.col(end) / width)))
    x = a.select("dataset", F.col("beg").alias("b1"), F.col("end").alias("e1")).withColumn("_bin", bins("b1", "e1"))
    y = b.select("dataset", F.col("beg").alias("b2"), F.col("end").alias("e2")).withColumn("_bin", bins("b2", "e2"))
    met = x.join(y, ["dataset", "_bin"]).where("b1 <= e2 and b2 <= e1")
    return merge_ranges(met.select("dataset", F.greatest("b1", "b2").alias("beg"), F.least("e1", "e2").alias("end")).distinct())


def coverage(desired: DataFrame, available: DataFrame) -> DataFrame:
    """What to fetch (``new``), what may go (``deletable``) and what stays (``needed``)."""
    kind = lambda df, k: df.select("dataset", "beg", "end", F.lit(k).alias("kind"))
    return kind(subtract_ranges(desired, available), "new").unionByName(kind(subtract_ranges(available, desired), "deletable")).unionByName(kind(intersect_ranges(desired, available), "needed"))


def find_range(ranges: DataFrame, points: DataFrame, width: int = 1 << 16) -> DataFrame:
    """For rows ``dataset, n`` the range that holds each."""
    binned = ranges.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("beg") / width), F.floor(F.col("end") / width))))
    return points.withColumn("_bin", F.floor(F.col("n") / width)).join(binned, ["dataset", "_bin"]).where("beg <= n and n <= end").drop("_bin")


def missing_blocks(df: DataFrame, number: str = "number", bucket: int = 100_000) -> DataFrame:
    """Heights absent between the least and the greatest. Buckets are looked through each by itself, then their edges."""
    rows = df.select(F.col(number).cast("long").alias("n")).distinct().withColumn("_bucket", F.floor(F.col("n") / bucket))
    inner = rows.select("n", F.lead("n").over(Window.partitionBy("_bucket").orderBy("n")).alias("next"))
    edges = rows.groupBy("_bucket").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    outer = edges.select(F.col("hi").alias("n"), F.lead("lo").over(Window.partitionBy(F.lit(0)).orderBy("_bucket")).alias("next"))  # a row a bucket
    gaps = inner.unionByName(outer).where("next > n + 1")
    return gaps.select(F.explode(F.sequence(F.col("n") + 1, F.col("next") - 1)).alias(number))
