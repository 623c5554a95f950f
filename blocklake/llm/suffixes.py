"""Exact substring dedup over bytes by a common-prefix-aware distributed merge sort of suffixes.

A string of ``length`` bytes that stands twice contains an anchor (its least-hashed gram) at the same place both times, so
it is enough to sort the suffixes that start at anchors whose gram occurs again. Tasks cut these suffixes, with the bytes
before them, from their texts, sort them and write them as front-coded runs: of each suffix only what it does not share
with the one before. Runs are exchanged by ranges of suffixes, whose bounds come from a sample, and merged by a loser tree that
keeps, for each run, how much its head shares with the last winner; heads that share different amounts are ordered without
a look at their bytes, and no known prefix is compared again. Range after range, the merges yield the sorted order of all
suffixes and the neighbours' common prefixes.

Neighbours alone do not settle a match, as it reaches both ways from the anchor: two suffixes that share ``r`` bytes from it
and ``l`` before it repeat ``l + r`` bytes. So each group of suffixes with one gram is united along falling common prefixes
(the smaller part into the larger), and each suffix that joins meets its two neighbours in the order of the bytes before.
That finds for each suffix the best ``l`` for every ``r`` in n log n steps, without going through all pairs.

A gram with more than ``HOT`` places is no task's group: there each string of ``length`` bytes around it is counted by its own
128-bit hash, which spreads over all tasks. Nothing is dropped.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import identified, slices, stored, table, text_buffers
from blocklake.llm.tokens import anchors, grouped, prefix_sums

LENGTH, GRAM = 200, 32
#: Places of a gram beyond which its strings are counted one by one.
HOT = 200_000
#: Suffixes of one range, about; at most so many grams are sampled to find the bounds, which decide balance alone.
RANGE, SAMPLE, BATCH_SAMPLE = 50_000, 32_768, 256
SPANS = "array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _binary(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def _distinct_anchors(sums: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    _, _, at, h = anchors(sums, bounds, length, gram)
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else at
    return at[new], h[new]


def _counts(length: int, gram: int):
    """Grams of anchors with their occurrences in a batch, and of those with the least hashes also their bytes, as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = -(-gram // 8)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            hs, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for a, b in slices(offsets):
                at, h = _distinct_anchors(prefix_sums(data[offsets[a] : offsets[b]]), offsets[a : b + 1] - offsets[a], length, gram)
                hs.append(h)
                places.append(at + offsets[a])
            h, first, n = np.unique(np.concatenate(hs), return_index=True, return_counts=True)
            at = np.concatenate(places)[first[:BATCH_SAMPLE]]
            grams = np.zeros((len(at), 8 * parts), np.uint8)
            grams[:, :gram] = data[at[:, None] + np.arange(gram)] if len(at) else 0
            # bytes as big-endian numbers with the first bit turned, so that their order is that of the bytes
            numbers = (grams.view(">u8").astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
            columns = [pa.array(np.r_[numbers[:, i], np.zeros(len(h) - len(at), np.int64)], mask=np.arange(len(h)) >= len(at)) for i in range(parts)]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n), *columns], ["h", "n", *(f"g{i}" for i in range(parts))])

    return run


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            ids, ths = batch.column("id").to_numpy(), batch.column("th").to_numpy()
            for a, b in slices(offsets):
                bounds = offsets[a : b + 1] - offsets[a]
                at, h = _distinct_anchors(prefix_sums(data[offsets[a] : offsets[b]]), bounds, length, gram)
                doc = np.searchsorted(bounds, at, "right") - 1
                h, doc, lists = grouped(h, doc, (at - bounds[doc]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[a + doc]), pa.array(ths[a + doc]), lists], ["h", "id", "th", "at"])

    return run


def bounds_of(sample: list[tuple[bytes, int]], ranges: int) -> list[bytes]:
    """Grams that cut the order of suffixes into at most ``ranges`` ranges of about the same number of places."""
    sample = sorted(sample)
    share, seen, out = sum(n for _, n in sample) / ranges, 0, []
    for gram, n in sample:
        if seen >= share * (len(out) + 1):
            out.append(gram)
        seen += n
    return out


def common(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix of two strings that share their first ``at`` bytes."""
    most = min(len(a), len(b))
    step = 16
    while at < most:
        x, y = a[at : at + step], b[at : at + step]
        if x == y:
            at += len(x)
            step *= 2
            if len(x) < len(y) or len(y) < len(x):
                break
            continue
        n = min(len(x), len(y))
        difference = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
        return at + (n - (difference.bit_length() + 7) // 8)
    return min(at, most)


def _runs(length: int, gram: int, hot: int, cuts: list[bytes]):
    """Front-coded sorted runs, one for each range and batch, of the candidate suffixes of a batch's texts.

    A row is a run: lists of shared prefix lengths, rest bytes, bytes before (reversed), and of each suffix's places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.list_(pa.struct([("id", pa.int64()), ("th", pa.int64()), ("at", pa.list_(pa.int32()))]))
        for batch in batches:
            texts, all_at = _binary(batch.column("text")), batch.column("anchors")
            ids, ths = batch.column("id").to_pylist(), batch.column("th").to_pylist()
            parts: dict[int, dict[tuple[bytes, bytes], dict]] = {}
            for i, mine in enumerate(all_at):
                mine = mine.as_py()
                if not mine:
                    continue
                text = texts[i].as_py()
                for x in mine:
                    if x["n"] > hot:
                        continue  # its strings go one by one
                    found = parts.setdefault(bisect_right(cuts, text[x["at"][0] : x["at"][0] + gram]), {})
                    for at in x["at"]:
                        key = (text[at : at + length], text[max(0, at - length + 1) : at][::-1])
                        found.setdefault(key, {}).setdefault(i, []).append(at)
            rows: list[list] = [[], [], [], [], []]
            for bucket, found in parts.items():
                keys, last = sorted(found), b""
                shared, rest = [], []
                for suffix, _ in keys:
                    n = common(last, suffix)
                    shared.append(n)
                    rest.append(suffix[n:])
                    last = suffix
                for column, value in zip(rows, (bucket, shared, rest, [before for _, before in keys], [[{"id": ids[i], "th": ths[i], "at": at} for i, at in found[k].items()] for k in keys]), strict=True):
                    column.append(value)
            kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(place)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["bucket", "shared", "rest", "before", "places"])

    return run


def _strings(length: int, gram: int, hot: int):
    """``a, b, id, th, at``: hashes of all strings of a text that hold a hot gram, and where they start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, all_at = _binary(batch.column("text")), batch.column("anchors")
            ids, ths, rows = batch.column("id").to_pylist(), batch.column("th").to_pylist(), []
            for i, mine in enumerate(all_at):
                grams = sorted(at for x in mine.as_py() or () if x["n"] > hot for at in x["at"])
                if not grams:
                    continue
                text, done, found = texts[i].as_py(), 0, {}
                for at in grams:  # a string that holds several is counted once
                    for start in range(max(done, at + gram - length), min(at, len(text) - length) + 1):
                        found.setdefault(xxhash.xxh3_128_intdigest(text[start : start + length]), []).append(start)
                        done = start + 1
                rows += [((h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63), ids[i], ths[i], at) for h, at in found.items()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "id", "th", "at"])

    return run


class Run:
    """A front-coded run that is read from its start; ``suffix`` is its head, ``lcp`` what that shares with the last winner."""

    __slots__ = ("at", "before", "lcp", "places", "rest", "shared", "suffix")

    def __init__(self, shared: list[int], rest: list[bytes], before: list[bytes], places: list):
        self.shared, self.rest, self.before, self.places = shared, rest, before, places
        self.at, self.suffix, self.lcp = 0, rest[0], 0

    def step(self) -> bool:
        """On to the next suffix. What it shares with the one before, the last winner, is known from the coding."""
        self.at += 1
        if self.at == len(self.rest):
            return False
        n = self.shared[self.at]
        self.suffix, self.lcp = self.suffix[:n] + self.rest[self.at], n
        return True


def merge(runs: list[Run]) -> Iterator[tuple[int, bytes, bytes, list]]:
    """``lcp with the suffix before, suffix, bytes before it, places`` in order, by a loser tree.

    All heads' ``lcp`` are with the last winner. Of two heads the one that shares more with it is the lesser; if they share
    alike, comparing starts where that ends, and the loser then knows what it shares with the one that beat it.
    """
    size = 1
    while size < len(runs):
        size *= 2
    alive: list[Run | None] = [*runs, *[None] * (size - len(runs))]
    losers = [0] * size

    def play(i: int, j: int) -> tuple[int, int]:
        a, b = alive[i], alive[j]
        if a is None or b is None:
            return (j, i) if a is None else (i, j)
        if a.lcp != b.lcp:
            return (i, j) if a.lcp > b.lcp else (j, i)
        n = common(a.suffix, b.suffix, a.lcp)
        if (a.suffix[n:], a.before[a.at]) <= (b.suffix[n:], b.before[b.at]):
            b.lcp = n
            return i, j
        a.lcp = n
        return j, i

    def build(node: int) -> int:
        if node >= size:
            return node - size
        win, losers[node] = play(build(2 * node), build(2 * node + 1))
        return win

    winner = build(1) if size > 1 else 0
    while (run := alive[winner]) is not None:
        yield run.lcp, run.suffix, run.before[run.at], run.places[run.at]
        if not run.step():
            alive[winner] = None
        node = (winner + size) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def matches(group: list[tuple[bytes, bytes, list]], shares: list[int], length: int) -> Iterator[tuple[int, int, int]]:
    """``item, l, r``: for each suffix of a group (sorted; ``shares`` with the one before) what it repeats around its anchor."""
    n = len(group)
    for i, (suffix, before, places) in enumerate(group):
        if (len(places) > 1 or len(places[0]["at"]) > 1) and len(suffix) + len(before) >= length:
            yield i, len(before), len(suffix)
    if n < 2:
        return
    rank_of = {b: k for k, b in enumerate(sorted({before for _, before, _ in group}))}
    rank = [rank_of[before] for _, before, _ in group]
    parent, members = list(range(n)), [[(rank[i], i)] for i in range(n)]

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for k in sorted(range(1, n), key=lambda k: -shares[k]):
        r, a, b = shares[k], find(k - 1), find(k)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members[b]
        for x in small:
            spot = bisect_left(large, x)
            for y in large[max(0, spot - 1) : spot + 1]:
                left = common(group[x[1]][1], group[y[1]][1])
                if left + r >= length:
                    yield x[1], left, r
                    yield y[1], left, r
        for x in small:
            insort(large, x)
        parent[b], members[b] = a, []


def _merge(length: int, gram: int):
    """Buckets one after another, from rows sorted by bucket: merged order, groups of one gram, spans of every place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, runs = None, []
        out: dict[tuple[int, int], list] = {}

        def group_done(group: list, shares: list[int]) -> None:
            if len(group) == 1 and len(group[0][2]) == 1 and len(group[0][2][0]["at"]) == 1:
                return
            best: dict[int, list[tuple[int, int]]] = {}
            for i, left, right in matches(group, shares, length):
                best.setdefault(i, []).append((left, right))
            for i, reach in best.items():
                reach.sort(reverse=True)
                far, kept = -1, []  # a span inside another says nothing new
                for left, right in reach:
                    if right > far:
                        kept.append((left, right))
                        far = right
                for place in group[i][2]:
                    spans = out.setdefault((place["id"], place["th"]), [])
                    spans += [(at - left, at + right) for at in place["at"] for left, right in kept]

        def done() -> None:
            group: list = []
            shares: list[int] = []
            for lcp, suffix, before, places in merge(runs) if runs else ():
                if group and lcp == len(suffix) == len(group[-1][0]) and before == group[-1][1]:
                    group[-1][2].extend(places)
                    continue
                if group and lcp < gram:
                    group_done(group, shares)
                    group, shares = [], []
                group.append((suffix, before, list(places)))
                shares.append(lcp)
            if group:
                group_done(group, shares)
            runs.clear()

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([k[0] for k in out], pa.int64()), pa.array([k[1] for k in out], pa.int64()), pa.array([[{"start": a, "end": b} for a, b in united(x)] for x in out.values()], _SPANS)], ["id", "th", "spans"])
            out.clear()
            return made

        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column("bucket")[i].as_py()
                if own != bucket:
                    done()
                    bucket = own
                runs.append(Run(*(batch.column(c)[i].as_py() for c in ("shared", "rest", "before", "places"))))
            yield batch_of()
        done()
        yield batch_of()

    return run


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans, in order."""
    runs: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], b))
        else:
            runs.append((a, b))
    return runs


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = _binary(batch.column("text"))
        size, removed, all_spans, kept = [], [], [], []
        for i, mine in enumerate(batch.column("spans")):
            own = texts[i].as_py()
            runs = united([(x["start"], x["end"]) for part in mine.as_py() or () for x in part])
            size.append(len(own))
            removed.append(sum(b - a for a, b in runs))
            all_spans.append([{"start": a, "end": b} for a, b in runs])
            at, left = 0, []
            for a, b in runs:
                left.append(own[at:a])
                at = b
            kept.append(b"".join([*left, own[at:]]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(all_spans, _SPANS), pa.array(kept, pa.binary())], ["doc_id", "th", "n_bytes", "n_removed", "spans", "kept"])


def dedup_bytes(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT, per_range: int = RANGE) -> DataFrame:
    """``doc_id, th, n_bytes, n_removed, spans, kept``: each row of ``docs`` without bytes of strings that stand elsewhere too.

    A byte of the UTF-8 text goes if a string of ``length`` bytes that covers it also starts at any other place of any row,
    the same row included; strings are judged on the input and never cross rows. ``spans`` are the maximal removed byte
    ranges (end excluded), ``kept`` the bytes left (a removed range may end inside a character), ``th`` the input text's
    hash. ``doc_id`` may be null and of any type. A null text is an empty one; texts shorter than ``length`` stay; rows that
    repeat are each other's copies; an empty table gives an empty one; other columns are left out. ``hot`` and ``per_range``
    decide how the work is dealt out, never the result.
    """
    spark = docs.sparkSession
    rows = identified(docs, text)
    parts = [f"g{i}" for i in range(-(-gram // 8))]
    counts = rows.select("text").mapInArrow(_counts(length, gram), "h long, n long, " + ", ".join(f"{g} long" for g in parts)).groupBy("h").agg(F.sum("n").alias("n"), *[F.max(g).alias(g) for g in parts])
    again = stored(counts.where("n > 1"), "grams")
    total = again.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("n").alias("most")).first()  # two numbers
    sample = again.where(F.col("g0").isNotNull() & (F.col("n") <= hot)).orderBy("h").limit(SAMPLE).collect()  # of bounded size
    as_bytes = lambda r: b"".join((r[g] + (1 << 63)).to_bytes(8, "big") for g in parts)[:gram]
    ranges = max(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), total["n"] // per_range)
    cuts = bounds_of([(as_bytes(r), r["n"]) for r in sample], ranges)

    # both sides come straight from an exchange, so a gram with a great part of the rows is split among tasks
    found = rows.select("id", "th", "text").mapInArrow(_anchors(length, gram), "h long, id long, th long, at array<int>")
    candidates = found.join(again.select("h", "n"), "h").groupBy("id", "th").agg(F.collect_list(F.struct("h", "n", "at")).alias("anchors"))
    by_row = rows.repartition("id", "th")  # one exchange of the texts serves all uses below
    met = by_row.join(candidates, ["id", "th"], "left")
    runs = met.mapInArrow(_runs(length, gram, hot, cuts), "bucket int, shared array<int>, rest array<binary>, before array<binary>, places array<array<struct<id:long,th:long,at:array<int>>>>")
    spans = runs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge(length, gram), f"id long, th long, spans {SPANS}")
    if (total["most"] or 0) > hot:
        strings = met.mapInArrow(_strings(length, gram, hot), "a long, b long, id long, th long, at array<int>")
        twice = strings.groupBy("a", "b").agg(F.sum(F.size("at")).alias("n")).where("n > 1").select("a", "b")
        of_hot = strings.join(twice, ["a", "b"]).select("id", "th", F.transform("at", lambda x: F.struct(x.alias("start"), (x + length).alias("end"))).alias("spans"))
        spans = spans.unionByName(of_hot)
    per_row = spans.groupBy("id", "th").agg(F.collect_list("spans").alias("spans"))
    kept = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(f"th long, n_bytes long, n_removed long, spans {SPANS}, kept binary").fields])
    return by_row.join(per_row, ["id", "th"], "left").mapInArrow(_clean, kept)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated strings of 200 bytes."""
    found = dedup_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op6_suffix_array_dedup": query}
SQL = {
    "op6_suffix_array_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
win AS (SELECT doc_id, k, md5(substr(x, 2 * k + 1, 400)) AS h FROM d, unnest(range(0, n - 199)) t(k)),
twice AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
hit AS (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM win SEMI JOIN twice USING (h)),
span AS (SELECT doc_id, min(k) AS a, max(k) + 200 AS b FROM (SELECT doc_id, k, sum(CASE WHEN before IS NULL OR k > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS g FROM hit) GROUP BY doc_id, g),
gap AS (SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM span WINDOW w AS (PARTITION BY doc_id ORDER BY a) UNION ALL SELECT doc_id, max(b), NULL FROM span GROUP BY doc_id),
cut AS (SELECT doc_id, string_agg(substr(x, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS kept FROM gap JOIN d USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM span GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN sums USING (doc_id)"""
}
