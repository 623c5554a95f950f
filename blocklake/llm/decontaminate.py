"""Benchmark decontamination by suffix arrays of the training texts.

Every task lays its documents out as shards of about a megabyte, builds the sorted array of their word suffixes, and
binary-searches every test suffix of the benchmark in it. Suffixes that cannot match are left out of the array: those
whose run of words known to the benchmark is shorter than any window that starts with their first word. Matches are
extended to the longest verbatim length, mapped to word spans, and affected documents are removed or reported.

Documents are never shuffled and their texts are read once: the benchmark goes to them in blocks of bounded bytes (one, for
most benchmarks), and every slice of documents is searched for all blocks in turn. Items are numbered; their ids, of any
type, come back by a join of what was found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import keyed, slices, spare, stored, table, text_buffers
from blocklake.llm.tokens import ALNUM, LOWER, prefix_sums, span_hash, words

WINDOW = 10
#: Bytes of benchmark text in a block, and how many blocks a pass over the documents takes along.
BLOCK_BYTES, BLOCKS = 16 << 20, 8

HITS = "th long, n_words long, spans array<struct<start:int,end:int>>, items array<long>, longest int"


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets, ALNUM)
    return span_hash(prefix_sums(data), starts, ends), bounds


def _keys(ids: np.ndarray, at: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """Words ``ids[at : at + length]`` as strings of ``width`` big-endian numbers whose order is that of the words' numbers."""
    matrix = np.zeros((len(at), width), ">u4")
    for k in range(width):
        on = length > k
        matrix[on, k] = ids[at[on] + k]
    return matrix.view(f"S{4 * width}").ravel() if len(at) else np.zeros(0, f"S{4 * width}")


def prepare(item_ids: list[int], texts: list[str], window: int = WINDOW) -> dict:
    """The test suffixes of a block of items that can be windows, in word order, with the numbers of the items they stand in."""
    data, offsets = text_buffers(pa.array([t or "" for t in texts], pa.string()))
    h, bounds = _word_hashes(data, offsets)
    vocabulary = np.unique(h)
    ids = np.searchsorted(vocabulary, h).astype(np.int64) + 1
    count = np.diff(bounds)
    size = np.minimum(count, window)
    item = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(ids))
    keep = at + size[item] <= bounds[1:][item]
    at, item = at[keep], item[keep]
    length = size[item]
    keys = _keys(ids, at, length, window)
    order = np.lexsort((at, length, keys))  # equal windows of one length side by side
    keys, at, item, length = keys[order], at[order], item[order], length[order]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (length[1:] != length[:-1])] if len(keys) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    shortest = np.full(len(vocabulary) + 1, 1 << 30, np.int64)
    np.minimum.at(shortest, ids[at], length)
    return {"vocabulary": vocabulary, "shortest": shortest, "keys": keys[first], "length": length[first], "at": at[first], "first": np.r_[first, len(keys)], "item": np.array(item_ids, np.int64)[item] if len(item) else np.zeros(0, np.int64), "ids": ids, "item_end": bounds[1:][item][first] if len(first) else first, "window": window}


def search(shard: tuple[np.ndarray, np.ndarray], test: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``position, window, longest`` of all places of a shard of texts (word hashes, bounds) where a test window starts."""
    h, bounds = shard
    none = np.zeros(0, np.int64)
    vocabulary, width = test["vocabulary"], test["window"]
    if not len(h) or not len(test["keys"]):
        return none, none, none
    ids = np.searchsorted(vocabulary, h).astype(np.int64)
    ids[ids == len(vocabulary)] = 0
    ids = np.where(vocabulary[ids] == h, ids + 1, 0)
    # how many known words follow in the same text, the word itself included
    n = len(ids)
    stop = np.zeros(n + 1, bool)
    stop[:n] = ids == 0
    stop[bounds] = True
    stops = np.flatnonzero(stop)
    position = np.arange(n)
    ahead = stops[np.searchsorted(stops, position + 1)] - position
    ahead[ids == 0] = 0
    position = np.flatnonzero((ids > 0) & (ahead >= test["shortest"][ids]))
    if not len(position):
        return none, none, none
    # the suffix array of the shard, to the depth of a window
    keys = _keys(ids, position, np.minimum(ahead[position], width), width)
    order = np.argsort(keys, kind="stable")
    keys, position = keys[order], position[order]
    low = np.searchsorted(keys, test["keys"], "left")
    upper = np.frombuffer(test["keys"].tobytes(), np.uint8).reshape(len(test["keys"]), -1).copy()
    upper[np.arange(upper.shape[1])[None, :] >= 4 * test["length"][:, None]] = 0xFF
    high = np.searchsorted(keys, upper.view(f"S{upper.shape[1]}").ravel(), "right")
    found = np.flatnonzero(high > low)
    many = (high - low)[found]
    if not len(found):
        return none, none, none
    place = np.repeat(low[found] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
    start, window = position[place], np.repeat(found, many)
    # the longest verbatim match with the first item that has the window
    longest = test["length"][window].astype(np.int64)
    active = np.arange(len(start))
    while len(active):
        a, w = start[active] + longest[active], test["at"][window[active]] + longest[active]
        more = (longest[active] < ahead[start[active]]) & (w < test["item_end"][window[active]])
        active, a, w = active[more], a[more], w[more]
        same = ids[a] == test["ids"][w]
        active = active[same]
        longest[active] += 1
    return start, window, longest


def _find(texts: tuple[np.ndarray, np.ndarray], tests: list[dict]) -> tuple[np.ndarray, list, list, np.ndarray]:
    """For each text: its words, the spans of hit words, the items found, the longest match; every slice meets all blocks."""
    data, offsets = texts
    n = len(offsets) - 1
    count, spans, items, longest = np.zeros(n, np.int64), [[] for _ in range(n)], [[] for _ in range(n)], np.zeros(n, np.int64)
    for a, b in slices(offsets):
        h, bounds = _word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        count[a:b] = np.diff(bounds)
        cover = np.zeros(len(h) + 1, np.int64)
        for test in tests:
            start, window, size = search((h, bounds), test)
            if not len(start):
                continue
            doc = np.searchsorted(bounds, start, "right") - 1
            np.maximum.at(longest, a + doc, size)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + test["length"][window], -1)
            pairs = np.unique(np.stack([doc, window]), axis=1)
            for d, w in pairs.T:
                items[a + int(d)].append(test["item"][test["first"][w] : test["first"][w + 1]])
        if not cover.any():
            continue
        hit = np.r_[False, np.cumsum(cover[:-1]) > 0, False]
        hit_text = np.r_[-1, np.searchsorted(bounds, np.arange(len(h)), "right") - 1, -1]
        edge = (hit[1:] != hit[:-1]) | (hit[1:] & hit[:-1] & (hit_text[1:] != hit_text[:-1]))
        at = np.flatnonzero(edge)
        for s, e in zip(at[:-1], at[1:], strict=True):
            if hit[s + 1]:
                d = int(hit_text[s + 1])
                spans[a + d].append({"start": int(s - bounds[d]), "end": int(e - bounds[d])})
    return count, spans, [np.unique(np.concatenate(x)).tolist() if x else [] for x in items], longest


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, th, n_words, spans, items, longest``: a row for each row of ``docs``; ``th`` is the text's hash.

    Words are runs of ASCII letters and digits and of all other signs outside ASCII, A-Z lower-cased. A window is ``window``
    consecutive words of an item, or all words of a shorter one; ``spans`` are maximal runs of document words (end excluded)
    inside occurrences of windows; ``items`` the ids of items with a window there, in order; ``longest`` the most words
    that match verbatim. Null or wordless texts and items have no windows; items that repeat count once by id; an item
    without an id is left out; rows of ``docs`` that repeat are reported each; other columns are left out. Ids of documents and
    of items may be of any type that sorts; ``items`` holds the latter (whole numbers as longs).
    """
    rows = keyed(docs, text)
    known = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    total = known.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0  # one number
    blocks = max(1, -(-total // block_bytes))
    kind = known.schema["item_id"].dataType
    numbered = isinstance(kind, T.IntegralType)
    if not numbered:  # a number for each id, the same in every run
        known = stored(known.withColumn("number", F.xxhash64("item_id")), "items")
        shared = known.groupBy("number").agg(F.count_distinct("item_id").alias("n")).where("n > 1")
        if not shared.isEmpty():  # by chance, at some 10^9 items
            raise ValueError("two item ids share a 64-bit hash: give items whole numbers as ids")
    number = F.col("item_id").cast("long") if numbered else F.col("number")
    sent = []
    for block in range(blocks):
        # a block holds about block_bytes, whatever the size of the benchmark
        mine = known.select(number.alias("number"), "text").where(F.pmod(F.xxhash64("number", "text"), F.lit(blocks)) == block).orderBy("number", "text").collect()
        sent.append(docs.sparkSession.sparkContext.broadcast(prepare([r["number"] for r in mine], [r["text"] for r in mine], window)))
    parts = []
    for first in range(0, blocks, BLOCKS):

        def run(batches: Iterator[pa.RecordBatch], sent=sent[first : first + BLOCKS]) -> Iterator[pa.RecordBatch]:
            tests = [x.value for x in sent]
            for batch in batches:
                count, spans, found, longest = _find(text_buffers(batch.column("text")), tests)
                pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                columns = [batch.column("doc_id"), batch.column("th"), pa.array(count), pa.array(spans, pair), pa.array(found, pa.list_(pa.int64())), pa.array(longest, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "th", "n_words", "spans", "items", "longest"])

        parts.append(rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(HITS).fields])))
    found = parts[0] if len(parts) == 1 else _merged(parts)
    return found if numbered else _with_ids(found, known)


def _merged(parts: list[DataFrame]) -> DataFrame:
    """What several passes found, as if one had."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # rows alike in id and text have alike results; each is kept as often as it stands in docs
    merged = every.groupBy("doc_id", "th").agg(F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("all"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("longest").alias("longest"), (F.count("*") / len(parts)).cast("int").alias("times"))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def join(s, x):
        last = F.element_at(s, -1)
        grown = F.concat(F.slice(s, 1, F.size(s) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when(F.size(s) == 0, F.array(x)).when(last["end"] >= x["start"], grown).otherwise(F.concat(s, F.array(x)))

    spans = F.when(F.size("all") > 0, F.aggregate("all", empty, join)).otherwise(empty)
    return merged.withColumn("spans", spans).withColumn("_", F.explode(F.sequence(F.lit(1), "times"))).select("doc_id", "th", "n_words", "spans", "items", "longest")


def _with_ids(found: DataFrame, known: DataFrame) -> DataFrame:
    """Item ids, in order, for the numbers of items: sets of items meet the ids, not documents one by one."""
    sets = found.where(F.size("items") > 0).select("items").distinct()
    names = sets.select("items", F.explode("items").alias("number")).join(known.select("number", "item_id").distinct(), "number").groupBy("items").agg(F.array_sort(F.collect_list("item_id")).alias("ids"))
    none = F.array().cast(names.schema["ids"].dataType)
    return found.join(names, "items", "left").select("doc_id", "th", "n_words", "spans", F.coalesce("ids", none).alias("items"), "longest")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) whose text has no window of any item; see :func:`matches` for words and windows."""
    own_id, own_th = spare(docs.columns, "_id", "_th")
    hit = matches(docs, items, window, text).where(F.size("spans") > 0).select(F.col("doc_id").alias(own_id), F.col("th").alias(own_th)).distinct()
    th = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    return docs.join(hit, F.col(own_id).eqNullSafe(docs["doc_id"]) & (F.col(own_th) == th), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the benchmark is in each document."""
    found = matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    names = F.array_join(F.sort_array(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


QUERIES = {"op8_benchmark_decontamination": query}
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {
    "op8_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS s FROM i, unnest(range(1, len(w) - n + 2)) t(k)),
dw AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS s FROM (SELECT d.*, l.n FROM d, (SELECT DISTINCT n FROM iw) l), unnest(range(1, len(w) - n + 2)) t(k)),
hits AS (SELECT doc_id, k, n, item_id FROM dw JOIN iw USING (n, s)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(k, k + n)) t(p) GROUP BY 1),
f AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN f USING (doc_id)"""
}
