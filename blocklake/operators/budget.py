"""Weights of selected rows, and which blocks fit a size budget.

The frames here have a row a block or a (block, weight) pair, never wide rows; items are read in full only for blocks that
the budget keeps. Running sums are by chunk; the global one sums chunks first, so no window holds a whole lake.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_WEIGHT, DEFAULT_LIMIT = 32, 40_000_000
#: Heights that one task sums up in order, where sums run over a whole range.
STRETCH = 100_000


def row_weight(weights: dict[str, int | str], columns: list[str]) -> Column:
    """What a row's selected columns weigh: a constant, the value of a size column (null: 0), or 32."""
    parts = []
    for c in columns:
        w = weights.get(c, DEFAULT_WEIGHT)
        parts.append(F.coalesce(F.col(w), F.lit(0)) if isinstance(w, str) else F.lit(w))
    return reduce(lambda a, b: a + b, parts, F.lit(0)).cast("long")


def block_weights(selected: list[DataFrame], always: DataFrame | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """``block_number, weight``: sums of ``(block_number, weight)`` rows; blocks of ``always`` count with 0."""
    parts = [s.select("block_number", "weight") for s in selected]
    if always is not None:
        parts.append(always.select("block_number", F.lit(0).cast("long").alias("weight")))
    every = reduce(DataFrame.unionByName, parts)
    if first is not None:
        every = every.where(F.col("block_number") >= first)
    if last is not None:
        every = every.where(F.col("block_number") <= last)
    return every.groupBy("block_number").agg(F.sum("weight").cast("long").alias("weight"))


def header_weight(weights: DataFrame, headers: DataFrame, weight: Column) -> DataFrame:
    """Adds each block's own header weight; blocks without a header go."""
    own = headers.select(F.col("number").alias("block_number"), weight.alias("_w"))
    return weights.join(own, "block_number").select("block_number", (F.col("weight") + F.col("_w")).cast("long").alias("weight"))


def budget_cut(weights: DataFrame, limit: int = DEFAULT_LIMIT, per: str | None = "chunk") -> DataFrame:
    """Blocks up to and including the first at which the running sum of weights exceeds ``limit``.

    ``per``: the column within which sums run. None: over all chunks in order of ``chunk``, by adding what earlier chunks sum
    up to, so that only one row a chunk is in one window.
    """
    own = Window.partitionBy(per or "chunk").orderBy("block_number").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("weight").over(own), F.lit(0))
    if per:
        return weights.withColumn("_before", before).where(F.col("_before") <= limit).drop("_before")
    totals = weights.groupBy("chunk").agg(F.sum("weight").alias("_total"))
    earlier = totals.select("chunk", F.coalesce(F.sum("_total").over(Window.partitionBy(F.lit(0)).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"))
    return weights.withColumn("_before", before).join(earlier, "chunk").where(F.col("_before") + F.col("_earlier") <= limit).drop("_before", "_earlier")


def include_all(headers: DataFrame) -> DataFrame:
    """Every block of the range, for requests that want all."""
    return headers.select(F.col("number").alias("block_number"))


def boundary_blocks(headers: DataFrame, per: str | None = None) -> DataFrame:
    """First and last block of the range, or of each chunk in it; they are part of every answer."""
    groups = [per] if per else []
    ends = headers.groupBy(*groups).agg(F.array_distinct(F.array(F.min("number"), F.max("number"))).alias("_ends"))
    return ends.select(F.explode("_ends").alias("block_number")).where("block_number is not null")


def chunk_ends(chunks: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """First and last height of each chunk's part of the range, from rows ``first_block, last_block``; a height without a block may be among them."""
    beg = F.greatest("first_block", F.lit(first if first is not None else 0))
    end = F.least("last_block", F.lit(last)) if last is not None else F.col("last_block")
    return chunks.select(beg.cast("long").alias("b"), end.cast("long").alias("e")).where("b <= e").select(F.explode(F.array_distinct(F.array("b", "e"))).alias("block_number"))


def assign_tops(chunks: DataFrame, top_dir_size: int = 500, last: int | None = None) -> DataFrame:
    """``chunks`` (``dataset, first_block, last_block``) with ``top``: a new top folder, named by its first height, every ``top_dir_size`` chunks.

    The chunk that ends at ``last``, the end of what is written, opens no folder of its own.
    """
    order = Window.partitionBy("dataset").orderBy("first_block")
    nth = F.row_number().over(order) - 1
    nth = F.when((F.col("last_block") == last) & (nth > 0), nth - 1).otherwise(nth) if last is not None else nth
    numbered = chunks.withColumn("_top", F.floor(nth / top_dir_size))
    return numbered.withColumn("top", F.min("first_block").over(Window.partitionBy("dataset", "_top"))).drop("_top")


def paginate(blocks: DataFrame, page_bytes: int, size: str = "size", per: str = "chunk", exact: bool = True) -> DataFrame:
    """``page`` numbers within a chunk: a page ends with the block at which its bytes exceed ``page_bytes``.

    The exact form restarts the count after each page, which is sequential, and so runs by chunk; the other form takes the
    running sum divided by the limit.
    """
    if not exact:
        before = Window.partitionBy(per).orderBy("block_number").rowsBetween(Window.unboundedPreceding, -1)
        return blocks.withColumn("page", F.floor(F.coalesce(F.sum(size).over(before), F.lit(0)) / page_bytes).cast("long"))
    return _greedy(blocks, page_bytes, size, per, "page", inclusive=True)


def _greedy(df: DataFrame, limit: int, size: str, per: str, name: str, inclusive: bool) -> DataFrame:
    import numpy as np
    from pyspark.sql import types as T

    def roll(pdf):
        pdf = pdf.sort_values("block_number", kind="stable")
        out, total, at = np.empty(len(pdf), np.int64), 0, 0
        for i, n in enumerate(pdf[size].fillna(0).to_numpy()):
            if not inclusive and total and total + n > limit:
                total, at = 0, at + 1
            out[i] = at
            total += n
            if inclusive and total > limit:
                total, at = 0, at + 1
        return pdf.assign(**{name: out})

    return df.groupBy(per).applyInPandas(roll, T.StructType([*df.schema.fields, T.StructField(name, T.LongType())]))


def assign_chunks(blocks: DataFrame, max_bytes: int, size: str = "size", per: str | None = None, bucket: int = 1_000_000, exact: bool = False) -> DataFrame:
    """``chunk`` numbers of blocks: a chunk rolls when its bytes exceed ``max_bytes``.

    ``per`` given: exact, greedy within each group of that column, a task a group. ``exact``: greedy over all blocks, see
    :func:`roll`. Else in bulk: the running sum before a block divided by the limit, by buckets of heights whose sums are added up first.
    """
    if exact and not per:
        return roll(blocks, max_bytes, size, "chunk", bucket)
    if per:
        return _greedy(blocks, max_bytes, size, per, "chunk", inclusive=True)
    parts = blocks.withColumn("_bucket", F.floor(F.col("block_number") / bucket))
    own = Window.partitionBy("_bucket").orderBy("block_number").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_bucket").agg(F.sum(size).alias("_t"))
    earlier = totals.select("_bucket", F.coalesce(F.sum("_t").over(Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_e"))
    before = F.coalesce(F.sum(size).over(own), F.lit(0))
    return parts.withColumn("_b", before).join(earlier, "_bucket").withColumn("chunk", F.floor((F.col("_b") + F.col("_e")) / max_bytes).cast("long")).drop("_b", "_e", "_bucket")


def roll(blocks: DataFrame, limit: int, size: str = "size", name: str = "chunk", bucket: int = 1_000_000) -> DataFrame:
    """``blocks`` with exact greedy numbers ``name`` over the whole table: a group ends with the block at which its bytes exceed ``limit``.

    Where a group that begins at a block ends follows from running sums: the next one begins at the first block whose sum before it
    is more than ``limit`` greater. That block is searched among those whose sums lie in the same stretch of ``limit`` bytes, or it
    is the first of the stretches beyond. The beginnings that the first block leads to are found by doubling: a round knows
    twice as many and jumps twice as far, so rounds grow with the log of the groups. Tasks hold a bucket of heights or a stretch of
    bytes; what joins them has a row a bucket, stretch or group. Null sizes are 0, heights are unique, other columns stay.
    """
    from blocklake.sources.shared import stored

    height = F.col("block_number")
    own = Window.partitionBy("_bucket").orderBy("block_number")
    joined = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row a bucket
    sized = blocks.withColumns({"_bucket": F.floor(height / bucket), "_size": F.coalesce(F.col(size), F.lit(0)).cast("long")})
    before = F.coalesce(F.sum("_size").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = sized.withColumns({"_i": F.row_number().over(own).cast("long") - 1, "_p": before})
    zero = lambda c: F.coalesce(F.sum(c).over(joined), F.lit(0)).cast("long")
    ahead = sized.groupBy("_bucket").agg(F.count("*").alias("_n"), F.sum("_size").alias("_t")).select("_bucket", zero("_n").alias("_i0"), zero("_t").alias("_p0"))
    rows = stored(inner.join(ahead, "_bucket").withColumns({"_i": F.col("_i") + F.col("_i0"), "_p": (F.col("_p") + F.col("_p0")).cast("long")}).drop("_i0", "_p0", "_size"), "roll")

    stretch = F.floor(F.col("_p") / limit).cast("long")
    points = rows.select(stretch.alias("v"), F.col("_p").alias("at"), F.lit(1).alias("kind"), F.col("_i").alias("point"), F.lit(None).cast("long").alias("s"))
    asked = rows.select((stretch + 1).alias("v"), (F.col("_p") + limit).alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("point"), F.col("_i").alias("s"))
    larger = Window.partitionBy("v").orderBy(F.desc("at"), "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = points.unionByName(asked).withColumn("next", F.min("point").over(larger)).where("kind = 0")
    beyond = Window.partitionBy(F.lit(0)).orderBy(F.desc("v")).rowsBetween(Window.unboundedPreceding, -1)  # a row a stretch
    firsts = points.unionByName(asked).groupBy("v").agg(F.min("point").alias("first")).select("v", F.min("first").over(beyond).alias("first"))
    jump = stored(found.join(firsts, "v").select("s", F.coalesce("next", "first").alias("next")).where("next is not null"), "jumps")

    starts = stored(rows.where("_i = 0").select(F.col("_i").alias("s")), "starts")
    while True:
        more = stored(starts.join(jump, "s").select(F.col("next").alias("s")), "starts")
        if more.isEmpty():
            break
        starts = starts.unionAll(more)
        then = jump.select(F.col("s").alias("next"), F.col("next").alias("then"))
        jump = stored(jump.join(then, "next").select("s", F.col("then").alias("next")), "jumps")

    marked = rows.join(starts.select(F.col("s").alias("_i"), F.lit(1).alias("_start")), "_i", "left")
    counts = marked.groupBy("_bucket").agg(F.count("_start").alias("_n")).select("_bucket", zero("_n").alias("_g"))
    nth = F.count("_start").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn(name, nth).join(counts, "_bucket").withColumn(name, (F.col(name) + F.col("_g") - 1).cast("long")).select(*[F.col(f"`{c}`") for c in blocks.columns], name)
