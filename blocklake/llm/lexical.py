"""Ranked lexical search of many queries at once, by shared partial sums.

The term sets of all queries are mined for what they share: pairs of neighbours that stand in two queries or more become nodes,
round after round, so that in the end every query is a short list of nodes of a sharing DAG (a node is the sum of two nodes of
earlier rounds or terms). A document's score for a query is a sum over terms, so the sum below a node is computed once for each
document and used by all queries above it.

Spark reads the texts once: the counts of all query terms in a document, and the document's length, are written as a narrow
table. A pass over it gives the corpus statistics (a number a term), another evaluates the DAG over slices of documents and
keeps each task's best documents of each query. These are ranked in two steps, so that no task gets more than a
bounded share of one query's candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import slices, stored, table, text_buffers
from blocklake.llm.tokens import ALNUM, LOWER, prefix_sums, span_hash, words

TOP = 10
#: Bytes of query texts that tasks get at a time; more queries go in blocks, each with its own pass over the texts.
BLOCK_BYTES = 32 << 20
#: Numbers in a slice's table of partial sums, about.
CELLS = 1 << 21
#: Groups that a query's candidates are ranked in first.
SALTS = 64


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of several texts, A-Z lower-cased, and where each text's begin."""
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets, ALNUM)
    return span_hash(prefix_sums(data), starts, ends), bounds


class Sharing(NamedTuple):
    """A DAG over the terms ``0 .. n_terms - 1``: each level's nodes are sums of two earlier nodes and follow those of the level before."""

    n_terms: int
    levels: list[tuple[np.ndarray, np.ndarray]]
    nodes: np.ndarray
    first: np.ndarray

    @property
    def size(self) -> int:
        return self.n_terms + sum(len(a) for a, _ in self.levels)


def mine(terms: np.ndarray, bounds: np.ndarray, n_terms: int) -> Sharing:
    """The sharing DAG of queries: ``terms[bounds[i] : bounds[i + 1]]`` are the different terms of query ``i``.

    Terms that many queries have stand first in a query, and those that stand in the same queries side by side. In a round, a
    pair of neighbours is chosen where it is more frequent than the pairs that overlap it (ties by its number), and becomes a
    node if it is chosen in two queries or more. The most frequent pair of a round is chosen everywhere, so rounds end.
    """
    count = np.diff(bounds)
    query = np.repeat(np.arange(len(count)), count)
    frequency = np.bincount(terms, minlength=n_terms)
    mark = np.random.default_rng(0).integers(0, 1 << 62, len(count)).astype(np.uint64)
    same = np.zeros(n_terms, np.uint64)
    np.add.at(same, terms, mark[query])  # equal for terms of the same queries
    place = np.empty(n_terms, np.int64)
    place[np.lexsort((np.arange(n_terms), same, -frequency))] = np.arange(n_terms)
    order = np.lexsort((place[terms], query))
    seq, levels, size = terms[order].astype(np.int64), [], n_terms
    while len(seq) > 1:
        near = query[1:] == query[:-1]
        code = np.where(near, seq[:-1] * size + seq[1:], -1)
        kinds, at, many = np.unique(code, return_inverse=True, return_counts=True)
        # a pair's priority as one number: how often it stands, then its rank
        rank = np.empty(len(kinds), np.int64)
        rank[np.lexsort((kinds, many))] = np.arange(1, len(kinds) + 1)
        weight = np.where(near & (many[at] > 1), rank[at], 0)
        padded = np.r_[0, weight, 0]
        chosen = (weight > 0) & (weight > padded[:-2]) & (weight > padded[2:])
        twice = np.bincount(at[chosen], minlength=len(kinds)) > 1
        chosen &= twice[at]
        if not chosen.any():
            break
        new = np.cumsum(twice) - 1 + size
        where = np.flatnonzero(chosen)
        made = kinds[twice]
        levels.append((made // size, made % size))
        seq[where] = new[at[where]]
        keep = np.ones(len(seq), bool)
        keep[where + 1] = False
        seq, query, size = seq[keep], query[keep], size + len(made)
    return Sharing(n_terms, levels, seq, np.searchsorted(query, np.arange(len(count) + 1)))


def sums(shared: Sharing, term: np.ndarray, doc: np.ndarray, value: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """``queries, scores``: of each query with a term in these documents its score in each, from the values of terms in documents.

    Only nodes with a term in one of the documents get a row; row 0 is that of all others.
    """
    active = np.zeros(shared.size, bool)
    active[term] = True
    at = shared.n_terms
    for left, right in shared.levels:
        active[at : at + len(left)] = active[left] | active[right]
        at += len(left)
    row = np.where(active, np.cumsum(active), 0)
    table_ = np.zeros((int(active.sum()) + 1, n_docs), np.int64)
    table_[row[term], doc] = value
    at = shared.n_terms
    for left, right in shared.levels:
        on = active[at : at + len(left)]
        table_[row[at : at + len(left)][on]] = table_[row[left[on]]] + table_[row[right[on]]]
        at += len(left)
    used = active[shared.nodes]
    first = np.r_[0, np.cumsum(used)][shared.first]
    queries = np.flatnonzero(np.diff(first) > 0)
    if not len(queries):
        return queries, np.zeros((0, n_docs), np.int64)
    return queries, np.add.reduceat(table_[row[shared.nodes[used]]], first[queries], axis=0)


def _count(vocabulary):
    """``doc_id, n, terms, tfs`` of every text with a term: its length, and the query terms in it with how often they stand there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for a, b in slices(offsets):
                h, bounds = _terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                n = np.diff(bounds)
                at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                hit = np.flatnonzero(known[at] == h) if len(known) else np.zeros(0, np.int64)
                doc = np.searchsorted(bounds, hit, "right") - 1
                key, tf = np.unique(doc * max(len(known), 1) + at[hit], return_counts=True)
                doc, term = key // max(len(known), 1), key % max(len(known), 1)
                first = pa.array(np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(first, pa.array(x.astype(np.int32))) for x in (term, tf)]
                keep = pa.array(n > 0)
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(n), *lists]
                yield pa.RecordBatch.from_arrays([c.filter(keep) for c in columns], ["doc_id", "n", "terms", "tfs"])

    return run


def _statistics(n_terms: int):
    """``term, n``: of each term how many of the task's documents hold it; -1 and -2 stand for documents and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, docs, total = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            found += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)[:n_terms]
            docs, total = docs + batch.num_rows, total + int(batch.column("n").to_numpy().sum())
        term = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[term, -1, -2]), pa.array(np.r_[found[term], docs, total])], ["term", "n"])

    return run


def damping(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """A document's ``m``: 10 and 90 times its length over the mean length, rounded down; in whole numbers of any size."""
    if len(n) and int(n.max()) * docs * 90 >= 1 << 63:
        return np.array([10 + 90 * int(x) * docs // total for x in n], np.int64)
    return 10 + 90 * n * docs // max(total, 1)


def _best(query: np.ndarray, score: np.ndarray, ids: pa.Array, k: int) -> np.ndarray:
    """Places of the ``k`` best of each query: highest score, then least id, null last."""
    rows = pa.table({"query": query, "score": score, "id": ids})
    order = pc.sort_indices(rows, sort_keys=[("query", "ascending"), ("score", "descending"), ("id", "ascending")]).to_numpy()
    q = query[order]
    return order[np.arange(len(q)) - np.searchsorted(q, q) < k]


def _rank(sent, k: int):
    """``item_id, doc_id, score``: the best documents of each query among those of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        program = sent.value
        shared, weight, docs, total, names = program["shared"], program["weight"], program["docs"], program["total"], program["names"]
        n_queries = len(names)
        threshold = np.ones(n_queries, np.int64)
        query, score, ids = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        step = max(8, min(512, CELLS // max(1, shared.size)))
        for batch in batches:
            n, lists, tf = batch.column("n").to_numpy(), batch.column("terms"), batch.column("tfs").flatten().to_numpy().astype(np.int64)
            bounds = lists.offsets.to_numpy().astype(np.int64)
            bounds, term = bounds - bounds[0], lists.flatten().to_numpy()
            doc_ids = batch.column("doc_id")
            order = np.empty(batch.num_rows, np.int64)
            order[pc.sort_indices(doc_ids).to_numpy()] = np.arange(batch.num_rows)
            m = damping(n, docs, total)
            found = []
            for a in range(0, batch.num_rows, step):
                b = min(a + step, batch.num_rows)
                lo, hi = bounds[a], bounds[b]
                if lo == hi:
                    continue
                doc = np.repeat(np.arange(a, b), np.diff(bounds[a : b + 1]))
                value = weight[term[lo:hi]] * (1_000_000_000 * tf[lo:hi] // (1000 * tf[lo:hi] + 8 * m[doc]))
                queries, table_ = sums(shared, term[lo:hi], doc - a, value, b - a)
                q, d = np.nonzero(table_ >= threshold[queries][:, None])
                s, q, d = table_[q, d], queries[q], d + a
                by = np.lexsort((order[d], -s, q))
                by = by[np.arange(len(by)) - np.searchsorted(q[by], q[by]) < k]
                found.append((q[by], s[by], d[by]))
            if not found:
                continue
            q, s, d = (np.concatenate(x) for x in zip(*found, strict=True))
            mine_ = doc_ids.take(pa.array(d))
            query, score = np.r_[query, q], np.r_[score, s]
            ids = mine_ if ids is None else pa.concat_arrays([ids, mine_])
            keep = _best(query, score, ids, k)
            query, score, ids = query[keep], score[keep], ids.take(pa.array(keep))
            last = np.flatnonzero(np.arange(len(query)) - np.searchsorted(query, query) == k - 1)
            threshold[query[last]] = np.maximum(1, score[last])
        if ids is not None:
            yield pa.RecordBatch.from_arrays([names.take(pa.array(query)), ids, pa.array(score)], ["item_id", "doc_id", "score"])

    return run


def _queries(items: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """``vocabulary, terms, bounds, names``: rows that share an id are one query, with the terms of all of them, each once."""
    data, offsets = text_buffers(items.column("text"))
    h, bounds = _terms(data, offsets)
    vocabulary, term = np.unique(h, return_inverse=True)
    coded = pc.dictionary_encode(items.column("item_id").combine_chunks(), null_encoding="encode")
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    query = np.repeat(coded.indices.to_numpy(), np.diff(bounds))
    key = np.unique(query.astype(np.int64) * max(1, len(vocabulary)) + term)
    query, term = key // max(1, len(vocabulary)), key % max(1, len(vocabulary))
    return vocabulary, term, np.searchsorted(query, np.arange(len(coded.dictionary) + 1)), coded.dictionary


def search(docs: DataFrame, items: DataFrame, k: int = TOP, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest score above 0 for each item, equal scores by ascending id.

    Terms are runs of ASCII letters and digits and of all signs outside ASCII, A-Z lower-cased. With N documents that have a
    term, L terms in them, n in one document, df documents with a term and tf of it in the document, the score is the sum over
    the item's different terms of ``floor(1000 ln((2N + 2) / (2 df + 1))) * (10^9 tf div (1000 tf + 8 m))`` where
    ``m = 10 + 90 n N div L``.

    Null, empty and wordless documents are in no result and count for nothing; null or wordless items have no rows. Rows of
    ``items`` that share an id (null is one) are one item with the terms of all. Rows of ``docs`` that repeat, or share an id, are
    documents each; which of two with the same id, score and item comes first makes no difference to the rows. A null id comes
    last among equal scores. Ids are of any type that sorts (numbers, strings, dates, binary); other columns are left out.
    """
    body = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = items.where(F.col("text").isNotNull()).select("item_id", "text")
    total = known.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0  # one number
    blocks = max(1, -(-total // block_bytes))
    kinds = (known.schema["item_id"], body.schema["doc_id"])
    parts = []
    for block in range(blocks):
        part = known if blocks == 1 else known.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        vocabulary, term, bounds, names = _queries(part.orderBy("item_id", "text").toArrow())  # block_bytes, whatever the size of the items
        spark = docs.sparkSession
        counted = T.StructType([kinds[1], *T.StructType.fromDDL("n long, terms array<int>, tfs array<int>").fields])
        counts = stored(body.mapInArrow(_count(spark.sparkContext.broadcast(vocabulary)), counted), "lexical")
        found = {r.term: r.n for r in counts.mapInArrow(_statistics(len(vocabulary)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}  # a number a term
        n_docs, length = found.get(-1, 0), found.get(-2, 0)
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * found.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
        program = {"shared": mine(term, bounds, len(vocabulary)), "weight": weight, "docs": n_docs, "total": length, "names": names}
        parts.append(counts.mapInArrow(_rank(spark.sparkContext.broadcast(program), k), T.StructType([*kinds, T.StructField("score", T.LongType())])))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = every.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*best))).where(F.col("rank") <= k)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op12_lexical_search": query}
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = {
    "op12_lexical_search": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
g AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS total FROM d WHERE len(ws) > 0),
i AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_WORDS}) AS t FROM benchmark)),
c AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS t FROM d) SEMI JOIN i USING (t) GROUP BY 1, 2, 3),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM c GROUP BY 1), g),
p AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // total))) AS v FROM c JOIN w USING (t), g),
s AS (SELECT item_id, doc_id, CAST(sum(v) AS BIGINT) AS score FROM i JOIN p USING (t) GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 10"""
}
