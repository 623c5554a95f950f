"""N-gram Jaccard join and its components by a size-aware heavy-light join.

Documents become sets of word shingles; equal sets are one. All shingles have one global order, common ones last (how
common is counted over all texts; the order decides cost, never results). Two sets that link share their first ``c``
common shingles within prefixes whose length follows from their sizes, so

* light (small) sets enumerate the subsets of two shingles of their prefix, and meet sets with an equal subset;
* heavy (large) sets are entered in inverted lists under each single shingle of their prefix, which are then scanned.

Of two sets that link, the smaller one has those shingles within a prefix of half the length (its index prefix): it shares at
least as many as two sets of its own size need. So a list's pairs are its members with those that stand in it by their index
prefix, and a list without such members has none: texts that share a template but are just too unlike are in no pair.

The size at the boundary is the one of the least estimated cost. Lists are never expanded into all pairs. First, each
set is compared with the most central set of its lists (a star), which settles dense groups of copies in one step each;
then, within a list, only sets of different components meet. Pairs are held against their prefixes, then compared in
full. A component is found whole: any pair not compared is in one component already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import identified, slices, stored, table, text_buffers
from blocklake.llm.components import connected_components
from blocklake.llm.tokens import LOWER, NOT_SPACE, mixed, prefix_sums, span_hash, words

WORDS, PERCENT = 4, 85
#: At most so many of the most common shingles stand last in the order (8 MB); others are ordered by hash.
MOST_COMMON = 1 << 20
#: A shingle counts as common from so many documents of one batch, and in all.
BATCH_COMMON, COMMON = 4, 64
#: Up to so many ids of sets are sent to the scan of texts; more meet them by a shuffle.
MOST_SENT = 500_000


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``text, hash`` of all word ``n``-grams of several texts; of a text with fewer words, all its words as one."""
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets, NOT_SPACE)
    sums = prefix_sums(span_hash(prefix_sums(data), starts, ends))
    count = np.diff(bounds)
    grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    text = np.repeat(np.arange(len(count)), grams)
    first = np.arange(len(text)) - np.repeat(np.r_[0, np.cumsum(grams)[:-1]], grams) + np.repeat(bounds[:-1], grams)
    return text, span_hash(sums, first, np.minimum(first + n, bounds[1:][text]))


def _distinct(text: np.ndarray, token: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct tokens of each of ``n`` texts, and where each text's begin."""
    order = np.lexsort((token, text))
    text, token = text[order], token[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (token[1:] != token[:-1])] if len(text) else np.zeros(0, bool)
    return token[new], np.searchsorted(text[new], np.arange(n + 1))


def _common(n: int):
    """Shingles of at least BATCH_COMMON texts of a batch, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            parts = []
            for a, b in slices(offsets):
                text, h = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n)
                parts.append(_distinct(text, h, b - a)[0])
            token, count = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
            keep = count >= BATCH_COMMON
            yield pa.RecordBatch.from_arrays([pa.array(token[keep].view(np.int64)), pa.array(count[keep])], ["token", "n"])

    return run


def placed(h: np.ndarray, common: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Tokens whose order as numbers is the global order: the highest 8 bits say how common, 56 bits are of the hash."""
    token = h >> np.uint64(8)
    if len(common):
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        token |= np.where(common[at] == h, level[at], 0).astype(np.uint64) << np.uint64(56)
    return token


def least_size(n: np.ndarray | int, percent: int):
    """The fewest tokens that a set of ``n`` shares with any that links to it."""
    return -(-n * percent // 100)


def _identity(token: np.ndarray, bounds: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set of tokens."""
    out = []
    for salt in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)):
        sums = np.r_[np.uint64(0), np.cumsum(mixed(token + salt))]
        out.append(mixed((sums[bounds[1:]] - sums[bounds[:-1]]) ^ (n.astype(np.uint64) << np.uint64(40))))
    return out[0], out[1]


def _sets(n_words: int, percent: int, sent, full: bool):
    """``doc_id, id, th, sid, other, n, prefix`` of every text, or (full) ``sid, tokens`` of texts.

    ``sid`` tells sets apart, ``other`` is a second hash of the set; a ``sid`` that unlike sets are known to share is mixed with it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, level, shared = sent.value
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            ids, ths = batch.column("id").to_numpy(), batch.column("th").to_numpy()
            for a, b in slices(offsets):
                text, h = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n_words)
                token, bounds = _distinct(text, placed(h, common, level), b - a)
                n = np.diff(bounds)
                sid, other = _identity(token, bounds, n)
                for again in shared:
                    sid = np.where(np.isin(sid, again), mixed(sid + mixed(other.copy())), sid)
                sid, other = sid.view(np.int64), other.view(np.int64)
                if full:
                    lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(token.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(sid), lists], ["sid", "tokens"])
                    continue
                length = np.where(n > 0, np.minimum(n, n - least_size(n, percent) + 2), 0)  # one more than single shingles need
                at = np.r_[0, np.cumsum(length)]
                pick = np.arange(at[-1]) - np.repeat(at[:-1], length) + np.repeat(bounds[:-1], length)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(token[pick].view(np.int64)))
                own = batch.column("doc_id").slice(a, b - a)
                yield pa.RecordBatch.from_arrays([own, pa.array(ids[a:b]), pa.array(ths[a:b]), pa.array(sid, mask=n == 0), pa.array(other), pa.array(n.astype(np.int32)), lists], ["doc_id", "id", "th", "sid", "other", "n", "prefix"])

    return run


def choose_boundary(sets: DataFrame, percent: int) -> int:
    """The set size up to which subsets cost less than inverted lists.

    A light set of ``n`` writes a row for each of its subsets; a heavy one a row for each prefix shingle, and scans its list.
    The mean length of the list of a prefix shingle is measured on those of one in 256 shingles; sizes are counted.
    """
    sampled = sets.select("sid", F.explode("prefix").alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(256)) == 0)
    lists = sampled.groupBy("t").agg(F.count("*").alias("f")).agg((F.sum(F.col("f") * F.col("f")) / F.sum("f")).alias("mean")).first()["mean"] or 1.0
    # sizes in steps of a quarter power of two: a few dozen rows
    sizes = sets.where("n > 1").groupBy(F.floor(F.log2("n") * 4).alias("bin")).agg(F.count("*").alias("sets"), F.avg("n").alias("n"), F.max("n").alias("most")).orderBy("bin").collect()
    best, boundary, light, heavy = None, 1, 0.0, 0.0
    prefix = lambda n: n - least_size(n, percent) + 1
    heavy = sum(r["sets"] * prefix(int(r["n"])) * (1 + lists) for r in sizes)
    best = heavy
    for r in sizes:
        p = prefix(int(r["n"]))
        heavy -= r["sets"] * p * (1 + lists)
        light += r["sets"] * (p + 1) * p / 2 * 2
        if light + heavy < best:
            best, boundary = light + heavy, int(r["most"])
    return boundary


def _keys(sets: DataFrame, boundary: int, percent: int) -> DataFrame:
    """``key, sid, n, pos, short``: where a set meets others. ``pos`` is the place of the key's first shingle in the set;
    ``short`` says that all its shingles stand in the index prefix."""
    need = lambda n: F.ceil(n * percent / F.lit(100))
    index = F.col("n") - shared_needed(F.col("n"), F.col("n"), percent) + 1  # a pair's second shingle may stand one further on
    kinds = "array<struct<key:bigint,pos:int,short:boolean>>"
    single = F.transform(F.slice("prefix", 1, (F.col("n") - need(F.col("n")) + 1).cast("int")), lambda t, i: F.struct(F.xxhash64(F.lit(1), t).alias("key"), i.alias("pos"), (i < index).alias("short")))
    pairs = F.flatten(F.transform("prefix", lambda t, i: F.transform(F.slice(F.col("prefix"), i + 2, F.size("prefix")), lambda u, k: F.struct(F.xxhash64(F.lit(2), t, u).alias("key"), i.alias("pos"), (i + 1 + k <= index).alias("short")))))
    # sets just above the boundary also meet lighter ones, which only have subsets
    light = F.when((F.col("n") > 1) & (F.col("n") <= F.floor(F.lit(boundary) * 100 / F.lit(percent))), pairs).otherwise(F.array().cast(kinds))
    heavy = F.when(F.col("n") > boundary, single).otherwise(F.array().cast(kinds))
    return sets.select("sid", "n", F.explode(F.concat(light, heavy)).alias("k")).select("k.key", "sid", "n", "k.pos", "k.short")


def shared_needed(a: Column, b: Column, percent: int) -> Column:
    """The least number of shared shingles with which sets of sizes ``a`` and ``b`` link."""
    return F.ceil((a + b) * percent / F.lit(100 + percent))


def _compatible(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Whether sets whose first common shingle stands at these places can share enough."""
    return F.least(na - pa_, nb - pb) >= shared_needed(na, nb, percent)


def jaccard_components(docs: DataFrame, text: str = "text", n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, th, n_shingles, component_id, component``: a row for each row of ``docs``; ``th`` is the text's hash.

    Words are runs of anything but the six ASCII white space signs, A-Z lower-cased; a set has the distinct runs of
    ``n_words`` words, or all words as one run if there are fewer. Two rows link when their sets share at least ``percent`` of
    their union; ``component_id`` is the least ``doc_id`` reachable by links. Null, empty and wordless texts have no shingles
    and stay by themselves, with their own id. Rows that repeat are in one component; ids that are null are left out of the
    least unless there is no other; an empty table gives an empty one; other columns are left out. ``component`` tells
    components apart also where ids are null or repeat; it is null for texts without shingles. ``doc_id`` may be of any type
    that sorts.
    """
    spark = docs.sparkSession
    rows = identified(docs, text)
    counted = rows.select("text").mapInArrow(_common(n_words), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    common = counted.orderBy(F.desc("n"), "token").limit(MOST_COMMON).toArrow()  # of bounded size
    token, level = common["token"].to_numpy().view(np.uint64), (1 + np.log2(common["n"].to_numpy().astype(np.float64) + 1)).astype(np.uint8)
    order = np.argsort(token)
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("id long, th long, sid long, other long, n int, prefix array<long>").fields])
    shared: list[np.ndarray] = []
    while True:
        sent = spark.sparkContext.broadcast((token[order], level[order], shared))
        sets = stored(rows.mapInArrow(_sets(n_words, percent, sent, False), schema), "sets")
        distinct = stored(sets.where("sid is not null").groupBy("sid").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), (F.min("other") != F.max("other")).alias("unlike")), "distinct")
        unlike = distinct.where("unlike").select("sid").toArrow()["sid"].to_numpy()  # a few at 10^10 sets, by chance
        if not len(unlike):
            break
        shared.append(unlike.view(np.uint64))
    boundary = choose_boundary(distinct, percent)
    # the lists, without those of one set; a list that holds a great part of the rows is split among tasks
    keys = _keys(distinct, boundary, percent)
    sizes = stored(keys.groupBy("key").agg(F.count("*").alias("size"), F.count_if("short").alias("shorts")).where("size > 1"), "list-sizes")
    lists = stored(keys.join(sizes, "key"), "lists")  # a list without members by their index prefix has no pairs, but tells who is central
    central = stored(lists.groupBy("sid").agg(F.sum("size").alias("weight")), "weights")  # a row for each set that is in a list
    prefixes = stored(distinct.select("sid", "n", "prefix").join(central, "sid", "left_semi"), "prefixes")  # both sides of both searches read it

    def verified(pairs: DataFrame) -> DataFrame:
        """Of pairs ``a, b`` of sets those that link: first by their prefixes, then by all their shingles."""
        a, b = (prefixes.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), F.col("prefix").alias(f"p{x}")) for x in "ab")
        both = pairs.join(a, "a").join(b, "b")
        # up to where both prefixes reach, all shingles of both sets are known
        reach = F.least(F.element_at("pa", -1), F.element_at("pb", -1))
        ka, kb = (F.filter(p, lambda t: t <= F.col("reach")) for p in ("pa", "pb"))
        most = F.size(F.array_intersect("ka", "kb")) + F.least(F.col("na") - F.size("ka"), F.col("nb") - F.size("kb"))
        near = both.withColumn("reach", reach).withColumn("ka", ka).withColumn("kb", kb).where(most >= shared_needed(F.col("na"), F.col("nb"), percent))
        near = stored(near.select("a", "b"), "near")
        n = near.count()
        if not n:
            return near
        wanted = near.select(F.col("a").alias("sid")).unionByName(near.select(F.col("b").alias("sid"))).distinct()
        firsts = sets.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.min(F.struct("id", "th")).alias("row")).select("row.id", "row.th")
        side = F.broadcast(firsts) if 2 * n <= MOST_SENT else firsts  # two sets a pair at most
        own = rows.join(side, ["id", "th"]).mapInArrow(_sets(n_words, percent, sent, True), "sid long, tokens array<long>").dropDuplicates(["sid"])
        tokens = stored(own, "tokens")
        a, b = (tokens.select(F.col("sid").alias(x), F.col("tokens").alias(f"t{x}")) for x in "ab")
        full = near.join(a, "a").join(b, "b").withColumn("shared", F.size(F.array_intersect("ta", "tb")))
        return stored(full.where(F.col("shared") * 100 >= (F.size("ta") + F.size("tb") - F.col("shared")) * percent).select("a", "b"), "links")

    # stars: each set with the set that is in the most and longest lists, of those it shares most lists with
    weighed = lists.join(central, "sid")
    pivots = weighed.groupBy("key").agg(F.max(F.struct("weight", "sid", "n", "pos")).alias("p"))
    to_pivot = lists.join(pivots.select("key", F.col("p.sid").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.pos").alias("pp")), "key")
    to_pivot = to_pivot.where((F.col("sid") != F.col("pivot")) & _compatible(F.col("n"), F.col("pos"), F.col("pn"), F.col("pp"), percent))
    tries = to_pivot.groupBy("sid", "pivot").agg(F.count("*").alias("m"))
    star = tries.groupBy("sid").agg(F.max_by("pivot", F.struct("m", "pivot")).alias("b")).select(F.col("sid").alias("a"), "b")
    links = verified(star)
    roots = connected_components(links)

    # what is left: sets of different components in one list, without the pairs inside the list's largest component
    labelled = lists.where("shorts > 0").join(roots.select(F.col("v").alias("sid"), "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    parts = labelled.groupBy("key", "root").agg(F.count("*").alias("m"))
    largest = parts.groupBy("key").agg(F.max(F.struct("m", "root"))["root"].alias("main"), F.count("*").alias("parts")).where("parts > 1")
    open_lists = stored(labelled.join(largest.select("key", "main"), "key").select("key", "sid", "n", "pos", "short", "root", (F.col("root") == F.col("main")).alias("in_main")), "open")
    # sets that link have sizes of one class or of the next: a list is met in stretches of sizes, not whole
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / min(percent, 99))) + 1e-9)
    near = F.explode(F.array(size_class - 1, size_class)).alias("class")
    # the larger set of a pair (of equals that of the greater number) meets what the smaller one has by its index prefix
    x = open_lists.select(F.col("key").alias("k"), F.col("sid").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("root").alias("ra"), F.col("in_main").alias("main"), near)
    y = open_lists.where("short").select("key", F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("root").alias("rb"), "in_main", size_class.alias("of"))
    larger = (F.col("na") > F.col("nb")) | (F.col("na") == F.col("nb")) & (F.col("a") > F.col("b"))
    meets = (F.col("k") == F.col("key")) & (F.col("class") == F.col("of")) & larger & (F.col("ra") != F.col("rb")) & _compatible(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"), percent)
    # two members of the list's largest component never meet
    pairs = x.where("not main").join(y, meets).select("a", "b").unionAll(x.where("main").join(y.where("not in_main"), meets).select("a", "b")).distinct()
    more = verified(pairs)
    if not more.isEmpty():  # links between components found so far: the graph of these is smaller, and mostly there is none
        of = lambda x: roots.select(F.col("v").alias(x), F.col("root").alias(f"r{x}"))
        between = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        merged = connected_components(between).select(F.col("v").alias("old"), F.col("root").alias("new"))
        # a set that no star links is a component of its own
        alone = more.select(F.explode(F.array("a", "b")).alias("v")).distinct().join(roots, "v", "left_anti").select("v", F.col("v").alias("root"))
        roots = roots.unionByName(alone).join(merged, F.col("root") == F.col("old"), "left").select("v", F.coalesce("new", "root").alias("root"))

    # the least id of each component, summed up by set before components meet
    of_set = stored(sets.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least")).join(roots.select(F.col("v").alias("sid"), "root"), "sid", "left").select("sid", "least", F.coalesce("root", "sid").alias("root")), "set-roots")
    least = of_set.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of_set.join(least, "root").select("sid", "component_id", F.col("root").alias("component"))
    out = sets.select("doc_id", "th", "sid", "n").join(named, "sid", "left")
    return out.select("doc_id", "th", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "component")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of all documents' sets and the components of their links."""
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op2_ngram_jaccard_join": query}
SQL = {
    "op2_ngram_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) t(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS v, doc_id AS r FROM d UNION SELECT both_ways.b, reach.r FROM reach JOIN both_ways ON both_ways.a = reach.v)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT v AS doc_id, min(r) AS component_id FROM reach GROUP BY 1) USING (doc_id)"""
}
