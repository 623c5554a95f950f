"""Connected components of a graph that is only known as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklake.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of the edges ``a, b`` (longs): ``root`` is the same within a component alone.

    Each round every vertex points to its least neighbour or itself, pointers are followed three steps on, and edges are drawn
    anew between what their ends point to; inner edges vanish. Where numbers are hashes, as all callers' are, rounds grow about
    with the log of the largest component; a chain in the order of its numbers loses four vertices a round. All state is in tables; a vertex with many edges only meets a sum over them. A round is three
    plans, as each takes the driver's memory and time, and what the rounds found is put together once, at the end.
    """
    live = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    found = []
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("root")), "pointers")
        point, up = least, least.select(F.col("v").alias("root"), F.col("root").alias("next"))
        for _ in range(3):  # what is pointed to is a vertex of its own
            point = point.join(up, "root").select("v", F.col("next").alias("root"))
        found.append(point := stored(point, "pointers"))
        a, b = (point.select(F.col("v").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
        drawn = live.join(a, "a").join(b, "b").where("ra <> rb")
        live = stored(drawn.select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), "edges")
    if not found:
        return edges.select(F.col("a").alias("v"), F.col("a").alias("root")).limit(0)
    known = found[0]
    for point in found[1:]:
        step = point.select(F.col("v").alias("root"), F.col("root").alias("next"))
        known = known.join(step, "root", "left").select("v", F.coalesce("next", "root").alias("root"))
    return known if len(found) == 1 else stored(known, "roots")
