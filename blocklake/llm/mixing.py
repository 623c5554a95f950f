"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents are dealt into blocks of their source by a hash. Each source owes the mix an exact number of its blocks (its
quota); a binary tree over the output shards splits these quotas: at each node the left half of the shards draws its
number of blocks without replacement, so the sources' counts there follow the multivariate hypergeometric law. A draw is
one number, found by inversion from the mode in steps that grow with the standard deviation, never block by block.
The leaves say how many blocks of each source a shard gets; these are then taken, disjoint, from the source's blocks in
permuted order, and each shard is shuffled by itself. No global permutation of documents is ever made: the tree works
on counts (a row a node, spread over tasks as it grows), the draw on blocks, and only the last step touches documents.
Blocks of a source are numbered in stretches of bounded size, so a source with a third of all rows is many tasks' work.

Spark functions alone; reruns agree, as every draw comes from a hash of the seed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blocklake.llm.common import let, space_count_words, stored, table


def with_targets(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """Rows ``source, source_size`` with the ``target`` of each source.

    Sources weigh as ``cycle`` says, in code point order, null last. All sizes together are shared by weight; no source
    gets more than ``max_repeat`` times its size, and what is cut off goes to the others by weight until nobody is above.
    The fixed point is found in closed form: ordered by size per weight, the capped sources are the first ones, and
    what is left of the total bounds the rest. One row a source, so the windows over all of them stay small.
    """
    every = Window.partitionBy(F.lit(0))
    ordered = sources.withColumn("n", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ordered.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.col("n") % len(cycle) + 1).cast("int"))).withColumn("cap", F.col("source_size") * float(max_repeat))
    by_ratio = every.orderBy((F.col("cap") / F.col("weight")).asc(), "n")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(every).cast("double")
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    shared = weighed.withColumn("level", left / weight_left).withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
    # the first source that is not capped sets the level of all that follow it
    level = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("n").alias("n"), F.col("level").alias("level")))).over(every)["level"]
    return shared.withColumn("target", F.when(F.col("capped") | level.isNull(), F.col("cap")).otherwise(F.col("weight") * level)).select("source", "source_size", "target")


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) that a hash of the parts gives."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / F.lit(float(1 << 53))


_QUOTAS = "array<struct<source:string,q:bigint>>"
#: Levels of the tree after which its nodes are dealt out to tasks anew.
LEVELS = 6
#: Rows that are put in order by one task, about; more of one source are cut into stretches.
STRETCH = 20_000


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, shifted by eight so that it is right to the last digits of a double."""
    x = n.cast("double") + 9
    shift = F.log((x - 1) * (x - 2) * (x - 3) * (x - 4) * (x - 5) * (x - 6) * (x - 7) * (x - 8))
    return let(x, lambda x: (x - 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5)))) - shift


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``good`` out of ``total`` are among ``drawn`` without replacement, where ``u`` in [0, 1) decides.

    From the mode outwards, one above and one below at a time, chances are added until they pass ``u``; nine standard
    deviations hold all that a double can tell from one.
    """

    def found(a: Column) -> Column:
        n, q, d = a["n"], a["q"], a["d"]
        least, most = F.greatest(F.lit(0).cast("long"), d + q - n), F.least(q, d)
        mode = F.greatest(least, F.least(most, F.floor((d + 1).cast("double") * (q + 1) / (n + 2)).cast("long")))
        sd = F.sqrt(d.cast("double") * q / n * (n - q) / n * (n - d) / F.greatest(n - 1, F.lit(1)))
        steps = F.least(most - least, F.ceil(sd * 9).cast("long") + 9)
        return let(F.struct(n.alias("n"), q.alias("q"), d.alias("d"), mode.alias("m"), steps.alias("steps"), a["u"].alias("u")), walk)

    def walk(a: Column) -> Column:
        n, q, d, m = a["n"], a["q"], a["d"], a["m"]
        ln = _log_factorial
        at_mode = F.exp(ln(q) - ln(m) - ln(q - m) + ln(n - q) - ln(d - m) - ln(n - q - d + m) - ln(n) + ln(d) + ln(n - d))
        none = F.lit(None).cast("long")
        start = lambda p: F.struct((a["u"] - p).alias("rest"), p.alias("up"), p.alias("down"), F.when(a["u"] < p, m).otherwise(none).alias("k"))

        def step(s: Column, i: Column) -> Column:
            j, up_to, down_to = i.cast("double"), m + i, m - i
            up = s["up"] * (q - m - j + 1) * (d - m - j + 1) / ((m + j) * (n - q - d + m + j))
            down = s["down"] * (m - j + 1) * (n - q - d + m - j + 1) / ((q - m + j) * (d - m + j))
            k = F.when(s["k"].isNotNull(), s["k"]).when(s["rest"] < up, up_to).when(s["rest"] < up + down, down_to)
            return F.struct((s["rest"] - up - down).alias("rest"), F.greatest(up, F.lit(0.0)).alias("up"), F.greatest(down, F.lit(0.0)).alias("down"), k.alias("k"))

        there = F.when(a["steps"] > 0, F.sequence(F.lit(1).cast("long"), F.greatest(a["steps"], F.lit(1).cast("long")))).otherwise(F.array().cast("array<bigint>"))
        return let(at_mode, lambda p: F.aggregate(there, start(p), step, lambda s: F.coalesce(s["k"], m)))

    sure = F.when((good <= 0) | (drawn <= 0), F.lit(0).cast("long")).when(drawn >= total, good).when(good >= total, drawn)
    return F.when(sure.isNotNull(), sure).otherwise(let(F.struct(total.cast("long").alias("n"), good.cast("long").alias("q"), drawn.cast("long").alias("d"), u.alias("u")), found))


def _draw(level: int, seed: int):
    """A fold step: how many of a source's blocks are among those that go left, given what sources before it took."""

    def step(s: Column, x: Column) -> Column:
        got = hypergeometric(s["left"], x["q"], s["room"], _unit(F.lit(seed), F.lit(level), F.col("shard"), x["source"]))
        mine = lambda k: F.array(F.struct(x["source"].alias("source"), k.alias("q"))).cast(_QUOTAS)
        return let(got, lambda k: F.struct((s["room"] - k).cast("long").alias("room"), (s["left"] - x["q"]).cast("long").alias("left"), F.concat(s["out"], mine(k)).alias("out")))

    return step


def split_quotas(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """``source, shard, n`` with ``n > 0`` for ``2 ** depth`` shards from rows ``source, quota``.

    The quotas of all sources are one array (a value a source), as is each node's; a level of the tree is a narrow step, and
    every LEVELS levels its nodes are dealt out to tasks.
    """
    root = F.sort_array(F.collect_list(F.struct(F.col("source").alias("source"), F.col("quota").cast("long").alias("q")))).cast(_QUOTAS)
    node = quotas.groupBy().agg(root.alias("qs")).select(F.lit(0).cast("long").alias("shard"), "qs")
    for level in range(depth):
        total = F.aggregate("qs", F.lit(0).cast("long"), lambda s, x: s + x["q"])
        # an odd block goes left or right by a hash, so that no shard is favoured
        odd = F.when((total % 2 == 1) & (_unit(F.lit(seed), F.lit(level), F.col("shard"), F.lit("odd")) < 0.5), F.lit(1)).otherwise(F.lit(0))
        state = F.struct((F.floor(total / 2) + odd).cast("long").alias("room"), total.alias("left"), F.array().cast(_QUOTAS).alias("out"))
        drawn = node.select("shard", "qs", F.explode(F.array(F.aggregate("qs", state, _draw(level, seed), lambda s: s["out"]))).alias("lefts"))
        rights = F.zip_with("qs", "lefts", lambda a, b: F.struct(a["source"].alias("source"), (a["q"] - b["q"]).alias("q"))).cast(_QUOTAS)
        children = F.array(F.struct((F.col("shard") * 2).alias("shard"), F.col("lefts").alias("qs")), F.struct((F.col("shard") * 2 + 1).alias("shard"), rights.alias("qs")))
        node = drawn.select(F.explode(children).alias("c")).select("c.shard", "c.qs")
        if (level + 1) % LEVELS == 0:
            node = node.repartition("shard")
    return node.select("shard", F.explode("qs").alias("x")).where("x.q > 0").select(F.col("x.source").alias("source"), "shard", F.col("x.q").alias("n"))


def lined_up(df: DataFrame, key: str, stretch: Column, order: list, name: str | None = None, size: str | None = None) -> DataFrame:
    """``df`` with ``rank``, each row's place from 0 among those of its ``key``, and ``before``, the sum of ``size`` of the rows ahead.

    ``stretch`` is a number that does not fall as ``order`` goes on, with few rows of each: a task orders rows of one stretch,
    and their sums, a row each, put the stretches together. ``df`` is stored under ``name`` if there is one; else it is read twice.
    """
    inner, value = Window.partitionBy(key, "stretch"), F.col(size) if size else F.lit(0).cast("long")
    cut = df.withColumn("stretch", stretch)
    cut = stored(cut, f"mix-{name}") if name else cut
    ahead = Window.partitionBy(key).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    sums = cut.groupBy(key, "stretch").agg(F.count("*").alias("rows"), F.sum(value).alias("sizes"))
    sums = sums.select(key, "stretch", F.coalesce(F.sum("rows").over(ahead), zero).alias("rows"), F.coalesce(F.sum("sizes").over(ahead), zero).alias("sizes"))
    mine = cut.withColumn("rank", F.row_number().over(inner.orderBy(*order)) - 1).withColumn("before", F.coalesce(F.sum(value).over(inner.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), zero))
    out = mine.join(sums, [key, "stretch"]).withColumn("rank", (F.col("rank") + F.col("rows")).cast("long")).withColumn("before", F.col("before") + F.col("sizes"))
    return out.drop("stretch", "rows", "sizes")


def _fill(placed: DataFrame, blocks: DataFrame, small) -> DataFrame:
    """``sk, block, r``: what a source gives of the blocks it does not give in full.

    Blocks follow each other in permuted order, documents in a block too, and each that fits the room left is taken. A round
    looks at documents that fit at its start: blocks of them go by a running sum, the first that crosses is gone through
    one by one, and the next round starts behind it with less room than a document that was left out. Each plan takes the
    driver's memory, so what the rounds took is gathered once, at the end.
    """
    opened = placed.where("size > 0").join(blocks.where(~F.col("full")).select("sk", "block", "rank"), ["sk", "block"]).select("sk", "block", "rank", "h", "r", "size")
    opened = stored(opened, "mix-open")
    zero = F.lit(0).cast("long")
    full_size = F.sum(F.when(F.col("full"), F.col("block_size")).otherwise(zero))
    state = blocks.groupBy("sk").agg((F.first("extra") - full_size).cast("double").alias("room"), F.sum(F.when(F.col("full"), zero + 1).otherwise(zero)).alias("from"))
    state = state.where("room > 0")
    ended, wholes, parts = state.select("sk", "room").where(F.lit(False)), [], []
    while True:
        fitting = opened.join(small(state), "sk").where((F.col("rank") >= F.col("from")) & (F.col("size") <= F.col("room")))
        if fitting.isEmpty():  # so the last look costs one plan, not a round of them
            ended = ended.unionByName(state.select("sk", "room"))
            break
        sums = fitting.groupBy("sk", "block", "rank").agg(F.sum("size").alias("n"), F.first("room").alias("room")).withColumnRenamed("rank", "place")
        sums = lined_up(sums, "sk", F.floor(F.col("place") / STRETCH), ["place"], "round", "n").withColumn("left", F.col("room") - F.col("before"))
        sums = stored(sums.where("left > 0").select("sk", "block", F.col("place").alias("rank"), "n", "left", "room"), "mix-sums")
        wholes.append(sums.where("n <= left").select("sk", "block", "room"))
        # a block has few words, so this is a short list
        start = F.struct(F.first("left").cast("double").alias("room"), F.array().cast("array<int>").alias("rs"))
        fits = lambda s, x: F.when(x["size"] <= s["room"], F.struct((s["room"] - x["size"]).cast("double").alias("room"), F.concat(s["rs"], F.array(x["r"])).alias("rs"))).otherwise(s)
        crossing = fitting.join(small(sums.where("n > left").select("sk", "block", "left")), ["sk", "block"]).groupBy("sk", "block", "rank").agg(F.sort_array(F.collect_list(F.struct("h", "r", "size"))).alias("docs"), start.alias("start"))
        crossing = stored(crossing.select("sk", "block", "rank", F.aggregate("docs", F.col("start"), fits).alias("end")), "mix-crossing")
        parts.append(crossing.select("sk", "block", F.explode("end.rs").alias("r")))
        # a source that no block crosses has taken all that fits
        used = sums.groupBy("sk").agg(F.sum("n").alias("used"))
        over = state.join(crossing.select("sk"), "sk", "left_anti").join(used, "sk", "left").select("sk", (F.col("room") - F.coalesce("used", zero)).alias("room"), zero.alias("from"), F.lit(True).alias("over"))
        after = crossing.select("sk", F.col("end.room").alias("room"), (F.col("rank") + 1).cast("long").alias("from"), (F.col("end.room") <= 0).alias("over"))
        left = stored(over.unionByName(after), "mix-room")
        ended = ended.unionByName(left.where("over").select("sk", "room"))
        state = left.where(~F.col("over")).select("sk", "room", "from")
    taken = placed.select("sk", "block", "r").where(F.lit(False))
    if wholes:  # a block is of one round at most
        whole = opened.join(reduce(DataFrame.unionByName, wholes), ["sk", "block"]).where(F.col("size") <= F.col("room")).select("sk", "block", "r")
        taken = stored(reduce(DataFrame.unionByName, [whole, *parts]), "mix-taken")
    near = opened.join(small(ended), "sk").where((F.col("size") > F.col("room")) & (F.col("size") < 2 * F.col("room"))).join(taken, ["sk", "block", "r"], "left_anti")
    last = near.groupBy("sk").agg(F.min(F.struct("size", "rank", "h", "block", "r")).alias("k")).select("sk", "k.block", "k.r")
    return taken.unionByName(last)


def mix(docs: DataFrame, size: Column | None = None, cycle: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, block_words: int = 100_000, shard_words: int = 4_000_000, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """``(draws, sizes)`` for rows ``doc_id, source``: what the mix takes, and every document's figures.

    ``draws``: ``doc_id, source, th, copy, shard, position``, a row for each copy of a document; ``th`` is the text's hash.
    ``sizes``: ``doc_id, source, th, size, source_size, target, taken, places``, a row for each of ``docs``; ``places`` are the
    shards and positions that it has in the mix. ``size`` is the number of words of ``text`` unless given; a null text has none
    and is never taken. A null source is a source of its own.
    Whole documents are taken: a source gives ``floor(target / size)`` full passes, and of one more pass its blocks in permuted
    order, every document that fits what is left of the target; at last the smallest of those left out, if its taking comes
    nearer to the target than its leaving.
    Rows alike in all columns are ranked and may be taken each; an empty table gives empty results; other columns are
    not looked at, so their names may be any.
    """
    key = F.concat(F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.lit("s")), F.coalesce("source", F.lit("")))
    words = space_count_words(F.col("text")) if size is None else size.cast("long")
    rows = stored(docs.select("doc_id", "source", key.alias("sk"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), F.coalesce(words, F.lit(0).cast("long")).alias("size")), "mix-sizes")
    per_source = rows.groupBy("sk").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    blocks_of = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / block_words).cast("long"))
    passes = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("long")
    targets = stored(with_targets(per_source, cycle, max_repeat).select(key.alias("sk"), "source_size", "target", blocks_of.alias("blocks"), passes.alias("passes")), "mix-targets")
    total = targets.agg(F.sum("target").alias("t"), F.count("*").alias("n")).first()  # two numbers
    depth = int(max(1.0, (total["t"] or 0) / shard_words) - 1e-9).bit_length() if total["t"] else 0
    small = F.broadcast if total["n"] <= 10_000 else (lambda df: df)  # one short row a source

    # every document has a place in a block of its source: the r-th of it
    h = F.xxhash64(F.lit(seed), "doc_id", "th", "size")
    inside = Window.partitionBy("sk", "block").orderBy("h", "doc_id", "th", "size")
    placed = rows.withColumn("h", h).join(small(targets.select("sk", "blocks")), "sk").withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "h"), F.col("blocks")))
    placed = stored(placed.select("doc_id", "source", "sk", "th", "h", "size", "block", F.row_number().over(inside).alias("r")), "mix-places")

    # the blocks of a source in permuted order: taken in full once more, in part, or not
    order = _unit(F.lit(seed), F.col("sk"), F.col("block"))
    stretches = F.floor(F.col("order") * F.ceil(F.col("blocks") / STRETCH))
    filled = placed.groupBy("sk", "block").agg(F.sum("size").alias("block_size")).join(small(targets), "sk").withColumn("order", order)
    lined = lined_up(filled, "sk", stretches, ["order", "block"], "line", "block_size")
    extra = F.col("target") - F.col("passes") * F.col("source_size")
    blocks = stored(lined.withColumn("full", extra - F.col("before") >= F.col("block_size")).select("sk", "block", "rank", "passes", "blocks", "block_size", extra.alias("extra"), "full"), "mix-blocks")
    chosen = stored(_fill(placed, blocks, small), "mix-chosen")
    blocks = blocks.join(chosen.select("sk", "block").distinct().withColumn("part", F.lit(True)), ["sk", "block"], "left")

    # what a source owes the mix: its blocks, pass by pass; each such item has a seat that the tree gives to a shard
    items = blocks.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes")))).where((F.col("copy") < F.col("passes")) | F.col("full") | F.col("part"))
    items = items.select("sk", "block", "copy", "blocks", ((F.col("copy") == F.col("passes")) & ~F.col("full")).alias("partly"), _unit(F.lit(seed + 1), F.col("sk"), F.col("block"), F.col("copy")).alias("order"))
    items = stored(lined_up(items, "sk", stretches, ["order", "block", "copy"]).withColumnRenamed("rank", "seat"), "mix-seats")
    shards = stored(split_quotas(items.groupBy("sk").agg(F.count("*").alias("quota")).select(F.col("sk").alias("source"), "quota"), depth, seed), "mix-tree")
    starts = lined_up(shards, "source", F.floor(F.col("shard") / STRETCH), ["shard"], size="n")
    seats = starts.select(F.col("source").alias("sk"), "shard", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("seat"))
    dealt = items.join(seats, ["sk", "seat"]).select("sk", "block", "copy", "shard", "partly")

    chosen = chosen.withColumn("chosen", F.lit(True))
    draws = placed.where("size > 0").join(chosen, ["sk", "block", "r"], "left").join(dealt, ["sk", "block"]).where(~F.col("partly") | F.col("chosen"))
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 2), "h", "r", "copy", "shard"), "doc_id", "r", "copy")
    mixed = stored(draws.select("doc_id", "source", "th", "sk", "block", "r", "copy", "shard", (F.row_number().over(local) - 1).cast("long").alias("position")), "mix-draws")
    times = mixed.groupBy("sk", "block", "r").agg(F.sort_array(F.collect_list(F.struct("shard", "position"))).alias("places"))  # as many as the repeats allowed
    sizes = placed.join(times, ["sk", "block", "r"], "left").join(small(targets.select("sk", "source_size", "target")), "sk").withColumn("places", F.coalesce("places", F.array().cast("array<struct<shard:bigint,position:bigint>>")))
    return mixed.select("doc_id", "source", "th", "copy", "shard", "position"), sizes.select("doc_id", "source", "th", "size", "source_size", F.col("target").cast("double").alias("target"), (F.size("places") * F.col("size")).cast("long").alias("taken"), "places")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: each one's words, its source's words and target, the words taken of it, and ``shard:position`` of each copy."""
    _, sizes = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    places = F.array_join(F.transform("places", lambda p: F.concat_ws(":", p["shard"], p["position"])), ",")
    return sizes.select("doc_id", "size", "source_size", "target", "taken", places.alias("places"))


QUERIES = {"op1_mixing": query}
SQL: dict[str, str] = {}
