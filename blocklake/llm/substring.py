"""Exact substring dedup over words by super-k-mer partitioning.

Every window of ``window`` words has a minimiser: the run of ``gram`` words in it with the least hash. Consecutive windows
that share their minimiser are one super-k-mer and travel as one packed string to the minimiser's bucket, where their
windows are sorted and counted, exactly, by their words. A window that stands twice has its minimiser twice, so only
super-k-mers whose minimiser occurs again anywhere are cut from the texts and sent at all.

Hot minimisers: equal super-k-mers are summed before they are sent, and a minimiser with more than ``HOT`` occurrences
sends its windows one by one to buckets by their own words, which spreads it over all tasks. Nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import identified, slices, stored, table, text_buffers
from blocklake.llm.tokens import NOT_SPACE, anchors, grouped, prefix_sums, span_hash, words

WINDOW, GRAM = 35, 10
#: Occurrences of a minimiser beyond which its windows travel one by one.
HOT = 20_000


def _word_sums(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over word hashes, from which the hash of any run of words is read, and each text's first word."""
    starts, ends, bounds = words(data, offsets, NOT_SPACE)
    return prefix_sums(span_hash(prefix_sums(data), starts, ends)), bounds


def _counts(window: int, gram: int):
    """Minimisers with their occurrences in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            parts = [anchors(*_word_sums(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), window, gram)[3] for a, b in slices(offsets)]
            h, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    return run


def _minimisers(window: int, gram: int):
    """A row for each text and minimiser: its super-k-mers as ``first << 32 | last`` window. A text that repeats itself has one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            ids, ths = batch.column("id").to_numpy(), batch.column("th").to_numpy()
            for a, b in slices(offsets):
                sums, bounds = _word_sums(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                first, last, at, h = anchors(sums, bounds, window, gram)
                doc = np.searchsorted(bounds, first, "right") - 1
                own = bounds[doc]
                h, doc, lists = grouped(h, doc, (first - own) << 32 | (last - own))
                columns = [pa.array(h.view(np.int64)), pa.array(ids[a + doc]), pa.array(ths[a + doc]), lists]
                yield pa.RecordBatch.from_arrays(columns, ["h", "id", "th", "runs"])

    return run


def hash_of(packed: bytes) -> int:
    return xxhash.xxh3_64_intdigest(packed) - (1 << 63)


def _pieces(text: bytes, found: list[dict], window: int, hot: int) -> Iterator[tuple[int, int, bytes]]:
    """``h, first, packed`` of a text's candidate super-k-mers; of hot minimisers, of each window by itself."""
    own = text.split()
    for x in found:
        for run in x["runs"]:
            first, last = run >> 32, run & 0xFFFFFFFF
            if x["n"] <= hot:
                yield x["h"], first, b" ".join(own[first : last + window])
            else:
                for i in range(first, last + 1):
                    packed = b" ".join(own[i : i + window])
                    yield hash_of(packed), i, packed


def _cut(window: int, hot: int, links: bool):
    """Packed strings with how often each stands in the batch, or (links) where in each text each stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary() if pa.types.is_string(batch.column("text").type) else pa.large_binary())
            found, ids, ths = batch.column("found"), batch.column("id").to_pylist(), batch.column("th").to_pylist()
            rows, sums = [], {}
            for i, mine in enumerate(found):
                places: dict[tuple[int, int], list[int]] = {}
                for h, first, packed in _pieces(texts[i].as_py(), mine.as_py() or (), window, hot):
                    if links:
                        places.setdefault((h, hash_of(packed)), []).append(first)
                    else:
                        sums[h, packed] = sums.get((h, packed), 0) + 1
                rows += [(h, sid, ids[i], ths[i], at) for (h, sid), at in places.items()]
            if links:
                names, kinds = ["h", "sid", "id", "th", "at"], [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            else:
                rows = [(h, hash_of(packed), packed, n) for (h, packed), n in sums.items()]
                names, kinds = ["h", "sid", "packed", "n"], [pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def count_windows(group: dict[int, tuple[bytes, int]], window: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """``sid, runs`` of a bucket's strings ``sid: (packed, n)``: runs of windows (first, last) that stand twice or more."""
    if len(group) == 1:
        for sid, (packed, n) in group.items():
            if n > 1:
                yield sid, [(0, packed.count(b" ") + 1 - window)]
        return
    each = []  # window, string, index
    for sid, (packed, _) in group.items():
        ends = [0, *accumulate(len(w) + 1 for w in packed.split(b" "))]
        each += [(packed[ends[i] : ends[i + window] - 1], sid, i) for i in range(len(ends) - window)]
    each.sort()
    twice: dict[int, list[int]] = {}
    i, m = 0, len(each)
    while i < m:
        j = i + 1
        while j < m and each[j][0] == each[i][0]:
            j += 1
        if j - i > 1 or group[each[i][1]][1] > 1:
            for _, sid, k in each[i:j]:
                twice.setdefault(sid, []).append(k)
        i = j
    for sid, at in twice.items():
        at.sort()
        runs = []
        for k in at:
            if runs and k <= runs[-1][1] + 1:
                runs[-1] = (runs[-1][0], k)
            else:
                runs.append((k, k))
        yield sid, runs


def _count(window: int):
    """Bucket by bucket, from rows sorted by ``h``; a bucket may reach over several batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        bucket, group = None, {}
        out: tuple[list, list, list] = ([], [], [])

        def done() -> None:
            for sid, runs in count_windows(group, window):
                out[0].append(bucket)
                out[1].append(sid)
                out[2].append([{"a": a, "b": b} for a, b in runs])

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], kind)], ["h", "sid", "twice"])
            for column in out:
                column.clear()
            return made

        for batch in batches:
            for h, sid, packed, n in zip(*(batch.column(c).to_pylist() for c in ("h", "sid", "packed", "n")), strict=True):
                if h != bucket:
                    done()
                    bucket, group = h, {}
                group[sid] = (packed, group[sid][1] + n if sid in group else n)
            yield batch_of()
        done()
        yield batch_of()

    return run


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary() if pa.types.is_string(batch.column("text").type) else pa.large_binary())
        total, removed, kept, spans = [], [], [], []
        for i, mine in enumerate(batch.column("spans")):
            own = texts[i].as_py().split()
            cut: list[list[int]] = []
            for x in sorted((x["start"], x["end"]) for part in mine.as_py() or () for x in part):
                if cut and x[0] <= cut[-1][1]:
                    cut[-1][1] = max(cut[-1][1], x[1])
                else:
                    cut.append(list(x))
            total.append(len(own))
            for a, b in reversed(cut):
                del own[a:b]
            removed.append(total[-1] - len(own))
            kept.append(b" ".join(own))
            spans.append([{"start": a, "end": b} for a, b in cut])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "th", "n_words", "n_removed", "spans", "text"])


def dedup_substrings(docs: DataFrame, text: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``doc_id, th, n_words, n_removed, spans, text``: each row of ``docs`` without words of windows that stand elsewhere too.

    Words are runs of anything but the six ASCII white space signs. A word goes if a window of ``window`` words that covers
    it also starts at any other place of any row, the same row included; all windows are judged on the input. ``spans``
    are the removed word ranges (end excluded), ``text`` the words left, joined by one blank, ``th`` the input text's hash.
    ``doc_id`` may be null and of any type. Null and empty texts have no words; texts shorter than a window stay; rows that
    repeat are each other's copies; an empty table gives an empty one; other columns are left out.
    """
    rows = identified(docs, text)
    counts = rows.select("text").mapInArrow(_counts(window, gram), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    again = stored(counts.where("n > 1"), "minimisers")
    # both sides come straight from an exchange, so a minimiser with a great part of the rows is split among tasks
    runs = rows.select("id", "th", "text").mapInArrow(_minimisers(window, gram), "h long, id long, th long, runs array<long>")
    candidates = runs.join(again, "h").groupBy("id", "th").agg(F.collect_list(F.struct("h", "n", "runs")).alias("found"))
    by_row = rows.repartition("id", "th")  # one exchange of the texts serves all three uses below
    found = by_row.join(candidates, ["id", "th"], "left")
    strings = found.mapInArrow(_cut(window, hot, False), "h long, sid long, packed binary, n long").repartition("h").sortWithinPartitions("h")
    twice = strings.mapInArrow(_count(window), "h long, sid long, twice array<struct<a:int,b:int>>")
    places = found.mapInArrow(_cut(window, hot, True), "h long, sid long, id long, th long, at array<int>")
    span = lambda at, x: F.struct((at + x["a"]).alias("start"), (at + x["b"] + window).alias("end"))
    spans = places.join(twice, ["h", "sid"]).select("id", "th", F.flatten(F.transform("at", lambda at: F.transform("twice", lambda x: span(at, x)))).alias("spans"))
    per_row = spans.groupBy("id", "th").agg(F.collect_list("spans").alias("spans"))
    kept = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("th long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, text string").fields])
    return by_row.join(per_row, ["id", "th"], "left").mapInArrow(_clean, kept)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated windows of 35 words."""
    return dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op5_substring_dedup": query}
SQL = {
    "op5_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, k, array_to_string(w[k:k + 34], ' ') AS s FROM d, unnest(range(1, len(w) - 33)) t(k)),
twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, k FROM win SEMI JOIN twice USING (s)), unnest(range(k, k + 35)) t(p)),
each_word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM each_word ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""
}
