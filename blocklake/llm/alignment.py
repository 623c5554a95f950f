"""Cross-tokenizer alignment with inverted pair bitmaps.

Every text is encoded by a byte-level BPE (A) and a piece BPE with byte fallback (B). Where tokens of both end at one byte, a
group ends; an A token and a B token are linked if their bytes overlap. Documents are numbered within blocks of bounded bytes.
For each pair of ids a block keeps compressed bitmaps of the documents that hold it: plane ``k`` has those whose number of
links has bit ``k``. Planes are OR-merged and counted for document counts, counted by weight for link counts, and summed over
blocks by pair. The counts then go back along the same postings: every plane adds its pair's count to its documents, block by
block, so no text is encoded twice and no document's pairs are sent one by one.

Encoding works on units: a text is cut at single spaces between signs that are no white space, where neither tokenizer can
join what stands on both sides. A task encodes and aligns a unit once. Texts with a unit that does not
come back byte for byte are encoded whole, so that units decide cost only.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import stored, table

#: Where the vocabularies are; read by the driver and sent to tasks (a few MB).
TOKENIZERS = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A block's texts have about so many bytes (one longer text is a block), and it has at most so many documents (16-bit numbers).
BLOCK_BYTES, BLOCK_DOCS = 4 << 20, 1 << 16
#: Units whose alignment a task keeps from block to block.
MOST_KNOWN = 500_000
#: Units that are handed to the tokenizers at a time.
AT_ONCE = 8192

_CUT = re.compile(r"(?<=\S) (?=\S)")
_POSTINGS = "a int, b int, plane int, n int, first int, size int, docs binary"
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _byte_of() -> dict[str, int]:
    """The sign that a byte-level vocabulary writes for each byte: itself if it can be printed, else the next one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs = {chr(b): b for b in plain}
    return signs | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}


class Coder:
    """Both tokenizers, and for each id its bytes and how it is written before each sign that can follow it."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(byte_bpe.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        byte_of = _byte_of()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for word, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in word) if all(c in byte_of for c in word) else word.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.text_a = [f"{i}{sign}".encode() for i in range(len(self.bytes_a)) for sign in ",|"]
        self.text_b = [f"{i}{sign}".encode() for i in range(len(self.bytes_b)) for sign in ",;"]
        # units are as good as whole texts where no piece joins a sign with white space after it, and white space stays as it is
        self.units = not any("▁" in p.lstrip("▁") for p in pieces) and self.a.normalizer is None and self.b.normalize("ﬁ  x") == "▁ﬁ▁▁x"

    def split(self, text: str) -> list[str]:
        return _CUT.split(text) if self.units else [text]

    def encode(self, units: list[str]) -> tuple[list, list]:
        """Ids of A for each unit after a space, and ids of B, which adds that space itself."""
        a: list = []
        b: list = []
        for k in range(0, len(units), AT_ONCE):
            part = units[k : k + AT_ONCE]
            a += [e.ids for e in self.a.encode_batch_fast([" " + u for u in part], add_special_tokens=False)]
            b += self.b.encode(part, num_threads=1)
        return a, b


@lru_cache(maxsize=2)
def _coder(byte_bpe: bytes, piece_bpe: bytes) -> Coder:
    return Coder(byte_bpe, piece_bpe)


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)), out=bounds[1:])
    return np.fromiter(chain.from_iterable(lists), np.int64, int(bounds[-1])), bounds


def _returns(units: list[str], ids: np.ndarray, bounds: np.ndarray, known: list[bytes], size: np.ndarray) -> np.ndarray:
    """For each unit whether its tokens' bytes are a space and the unit."""
    truth = [(" " + u).encode() for u in units]
    got = b"".join(map(known.__getitem__, ids.tolist()))
    ends = np.r_[0, np.cumsum(size[ids])][bounds]
    if got == b"".join(truth) and (np.diff(ends) == np.fromiter(map(len, truth), np.int64, len(truth))).all():
        return np.ones(len(units), bool)
    return np.array([got[s:e] == t for s, e, t in zip(ends[:-1].tolist(), ends[1:].tolist(), truth, strict=True)], bool)


class Units(NamedTuple):
    """What units come to: whether they are whole, tokens, groups and links of each, its groups as text, and its pairs with how often they are linked."""

    ok: np.ndarray
    counts: np.ndarray
    groups: list[bytes]
    pair: np.ndarray
    times: np.ndarray
    bounds: np.ndarray


def aligned_units(coder: Coder, units: list[str]) -> Units:
    """Aligns different units, all at once: those that hold are laid end to end, and both tokenizers' ends cut the same line."""
    lists_a, lists_b = coder.encode(units)
    (a, at_a), (b, at_b) = _flat(lists_a), _flat(lists_b)
    ok = _returns(units, a, at_a, coder.bytes_a, coder.size_a) & _returns(units, b, at_b, coder.bytes_b, coder.size_b)
    n_a, n_b = np.where(ok, np.diff(at_a), 0), np.where(ok, np.diff(at_b), 0)
    a, b = a[np.repeat(ok, np.diff(at_a))], b[np.repeat(ok, np.diff(at_b))]
    end_a, end_b = np.cumsum(coder.size_a[a]), np.cumsum(coder.size_b[b])
    line = np.sort(np.r_[end_a, end_b], kind="stable")
    again = np.zeros(len(line), bool)
    again[1:] = line[1:] == line[:-1]
    ends, both = line[~again], line[again]  # a link ends at each end of either: the tokens that hold its last byte
    link_a, link_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
    unit_end = np.r_[0, end_a][np.r_[0, np.cumsum(n_a)]]
    n_groups = np.diff(np.searchsorted(both, unit_end, "right"))
    link_at = np.searchsorted(ends, unit_end, "right")
    counts = np.stack([n_a, n_b, n_groups, np.diff(link_at)])
    # groups as text: A ids, then B ids of a group, each with the sign that follows
    group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
    last_a, last_b = both[group_a] == end_a, both[group_b] == end_b
    order = np.argsort(np.r_[2 * group_a, 2 * group_b + 1], kind="stable")
    written = [*map(coder.text_a.__getitem__, (2 * a + last_a).tolist()), *map(coder.text_b.__getitem__, (2 * b + last_b).tolist())]
    written = [written[k] for k in order.tolist()]
    size = np.fromiter(map(len, written), np.int64, len(written))
    text, cut = b"".join(written), np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(n_a + n_b)]].tolist()
    groups = [text[s:e] for s, e in zip(cut[:-1], cut[1:], strict=True)]
    # pairs of each unit
    pair = a[link_a] * len(coder.bytes_b) + b[link_b]
    unit = np.repeat(np.arange(len(units)), np.diff(link_at))
    order = np.lexsort((pair, unit))
    pair, unit = pair[order], unit[order]
    first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (unit[1:] != unit[:-1])]) if len(pair) else np.zeros(0, np.int64)
    return Units(ok, counts, groups, pair[first], np.diff(np.r_[first, len(pair)]), np.searchsorted(unit[first], np.arange(len(units) + 1)))


def _spans(bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the lists of ``rows``, one list after the other, and which row of ``rows`` each is from."""
    n = bounds[rows + 1] - bounds[rows]
    start = np.repeat(bounds[rows] - np.r_[0, np.cumsum(n)[:-1]], n) if len(n) else np.zeros(0, np.int64)
    return start + np.arange(len(start)), np.repeat(np.arange(len(rows)), n)


def _summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sum of their values."""
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(value, first) if len(first) else value


def _joined(x: Units, y: Units) -> Units:
    return Units(np.r_[x.ok, y.ok], np.concatenate([x.counts, y.counts], axis=1), x.groups + y.groups, np.r_[x.pair, y.pair], np.r_[x.times, y.times], np.r_[x.bounds[:-1], y.bounds + x.bounds[-1]])


class Known:
    """Units that a task has aligned, up to MOST_KNOWN at the start of a block; then it begins anew."""

    def __init__(self, coder: Coder):
        self.coder, self.codes, self.units = coder, {}, None

    def number(self, texts: list[str | None]) -> list[list[int]]:
        """Units of each text, by number; those that are new are aligned."""
        if len(self.codes) > MOST_KNOWN:
            self.codes, self.units = {}, None
        codes, before = self.codes, len(self.codes)
        number = [[codes.setdefault(u, len(codes)) for u in self.coder.split(t)] if t else [] for t in texts]
        fresh = aligned_units(self.coder, list(islice(codes, before, None)))
        self.units = fresh if self.units is None else _joined(self.units, fresh)
        return number


def aligned(coder: Coder, texts: list[str | None], known: Known) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of texts: counts and digest of each, and its pairs as ``pair, doc, times`` in this order."""
    number = known.number(texts)
    units, n_units = known.units, len(known.codes)
    unit, bounds = _flat(number)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    bad = np.unique(doc[~units.ok[unit]])
    if len(bad):  # whole texts instead; where they do not come back either, the document has no tokens
        again = aligned_units(coder, [texts[d] for d in bad])
        units = _joined(units, again)
        keep = ~np.isin(doc, bad)
        unit, doc = np.r_[unit[keep], np.arange(len(bad))[again.ok] + n_units], np.r_[doc[keep], bad[again.ok]]
        order = np.argsort(doc, kind="stable")
        unit, doc = unit[order], doc[order]
        bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    counts = np.zeros((len(_COUNTS), len(texts)), np.int64)
    for k in range(len(_COUNTS)):
        counts[k] = np.diff(np.r_[0, np.cumsum(units.counts[k][unit])][bounds])
    seq, cut = unit.tolist(), bounds.tolist()
    digests = [hashlib.sha256(b"".join([units.groups[u] for u in seq[s:e]])[:-1]).hexdigest() if e > s else "" for s, e in zip(cut[:-1], cut[1:], strict=True)]
    key, many = _summed(doc * len(units.ok) + unit, np.ones(len(unit), np.int64))
    doc, unit = key // len(units.ok) if len(key) else key, key % len(units.ok) if len(key) else key
    place, row = _spans(units.bounds, unit)
    key, times = _summed(units.pair[place] * len(texts) + doc[row], units.times[place] * many[row])
    return counts, digests, key // max(1, len(texts)), key % max(1, len(texts)), times


def packed(row: np.ndarray, doc: np.ndarray, n_rows: int, size: int) -> pa.Array:
    """A bitmap of ``size`` documents for each row: a list of 16-bit numbers where that is shorter than a bit a document."""
    n = np.bincount(row, minlength=n_rows)
    width = -(-size // 8)
    dense = 2 * n > width
    offsets = np.zeros(n_rows + 1, np.int64)
    np.cumsum(np.where(dense, width, 2 * n), out=offsets[1:])
    data = np.zeros(int(offsets[-1]), np.uint8)
    on = dense[row]
    np.bitwise_or.at(data, offsets[row[on]] + (doc[on] >> 3), (1 << (doc[on] & 7)).astype(np.uint8))
    first = np.r_[0, np.cumsum(n)[:-1]]
    at = (offsets[row] + 2 * (np.arange(len(row)) - first[row]))[~on]
    data[at], data[at + 1] = doc[~on] & 0xFF, doc[~on] >> 8
    return pa.Array.from_buffers(pa.binary(), n_rows, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def unpacked(docs: pa.Array, n: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``row, doc`` of every bit of bitmaps made by :func:`packed`; ``n`` bits in each, of ``size`` documents."""
    if isinstance(docs, pa.ChunkedArray):
        docs = docs.combine_chunks()
    offsets = np.frombuffer(docs.buffers()[1], np.int32)[docs.offset : docs.offset + len(docs) + 1].astype(np.int64)
    data = np.frombuffer(docs.buffers()[2], np.uint8) if docs.buffers()[2] is not None else np.zeros(0, np.uint8)
    width = -(-size // 8)
    dense = 2 * n > width
    sparse, full = np.flatnonzero(~dense), np.flatnonzero(dense)
    row = np.repeat(sparse, n[sparse])
    at = offsets[row] + 2 * (np.arange(len(row)) - np.repeat(np.r_[0, np.cumsum(n[sparse])[:-1]], n[sparse])) if len(row) else row
    doc = data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8 if len(row) else row
    which = np.repeat(full, width[full])
    at = offsets[which] + np.arange(len(which)) - np.repeat(np.r_[0, np.cumsum(width[full])[:-1]], width[full]) if len(which) else which
    byte, bit = np.nonzero(np.unpackbits(data[at], bitorder="little").reshape(-1, 8)) if len(which) else (which, which)
    return np.r_[row, which[byte]], np.r_[doc, (at - offsets[which])[byte] * 8 + bit]


def planes(pair: np.ndarray, doc: np.ndarray, times: np.ndarray, size: int, n_b: int) -> pa.RecordBatch:
    """Postings of a block: a row for each pair and bit of its multiplicities, with how many documents are in this plane and in no lower one."""
    low = times & -times
    parts: list = []
    for k in range(int(times.max()).bit_length() if len(times) else 0):
        on = times >> k & 1 == 1
        p, d, new = pair[on], doc[on], low[on] == 1 << k
        first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]]) if len(p) else np.zeros(0, np.int64)
        if len(first):
            n = np.diff(np.r_[first, len(p)])
            row = np.repeat(np.arange(len(first)), n)
            parts.append((p[first], np.full(len(first), k), n, np.add.reduceat(new.astype(np.int64), first), packed(row, d, len(first), size)))
    numbers = [np.concatenate(x) for x in list(zip(*parts, strict=True))[:4]] if parts else [np.zeros(0, np.int64)] * 4
    ab = [numbers[0] // n_b, numbers[0] % n_b]
    columns = [pa.array(x.astype(np.int32)) for x in (*ab, *numbers[1:], np.full(len(ab[0]), size))]
    return pa.RecordBatch.from_arrays([*columns, pa.concat_arrays([x[4] for x in parts]) if parts else pa.array([], pa.binary())], ["a", "b", "plane", "n", "first", "size", "docs"])


def _index(sent, schema: pa.Schema):
    """Rows of documents and rows of postings, block by block; a row has the columns of one kind, and nulls for the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*sent.value)
        known, block, held, size = Known(coder), TaskContext.get().partitionId() << 32, [], 0

        def made() -> Iterator[pa.RecordBatch]:
            ids, texts = pa.concat_arrays([x[0] for x in held]), list(chain.from_iterable(x[1] for x in held))
            counts, digests, pair, doc, times = aligned(coder, texts, known)
            postings = planes(pair, doc, times, len(texts), len(coder.bytes_b))
            own = {"doc_id": ids, "ord": pa.array(np.arange(len(texts), dtype=np.int32)), "groups_sha256": pa.array(digests, pa.string())} | {c: pa.array(x) for c, x in zip(_COUNTS, counts, strict=True)}
            yield from rows(own, len(texts))
            yield from rows({f: postings.column(f) for f in postings.schema.names}, postings.num_rows)

        def rows(columns: dict, n: int) -> Iterator[pa.RecordBatch]:
            columns["block"] = pa.array(np.full(n, block))
            yield pa.RecordBatch.from_arrays([columns.get(f.name, None) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            start = 0
            for k, t in enumerate(texts):
                size += len(t.encode()) if t else 0
                if size >= BLOCK_BYTES or k + 1 - start + sum(len(x[1]) for x in held) >= BLOCK_DOCS or k + 1 == len(texts):
                    held.append((ids.slice(start, k + 1 - start), texts[start : k + 1]))
                    start = k + 1
                    if size >= BLOCK_BYTES or sum(len(x[1]) for x in held) >= BLOCK_DOCS:
                        yield from made()
                        block, held, size = block + 1, [], 0
        if held:
            yield from made()

    return run


def index(docs: DataFrame, tokenizers: str = TOKENIZERS, text: str = "text") -> DataFrame:
    """The stored index of ``docs``: rows of documents (``block, ord, doc_id``, counts, digest) and rows of postings
    (``block, a, b, plane, n, first, size, docs``), whose ``docs`` is a bitmap over the ``ord`` of its block."""
    body = docs.select("doc_id", F.col(text).alias("text"))
    files = [open(os.path.join(tokenizers, name), "rb").read() for name in (BYTE_BPE, PIECE_BPE)]
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ord", T.IntegerType()), body.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("groups_sha256", T.StringType()), *T.StructType.fromDDL(_POSTINGS).fields])
    arrow = docs.sparkSession.createDataFrame([], schema).toArrow().schema
    return stored(body.mapInArrow(_index(docs.sparkSession.sparkContext.broadcast(files), arrow), schema), "alignment")


def pair_counts(indexed: DataFrame) -> DataFrame:
    """``a, b, docs, links, best``: for each pair of ids the documents that link it, its links, and whether no pair of ``b`` has more."""
    links = F.call_function("shiftleft", F.col("n").cast("long"), F.col("plane"))
    counted = indexed.where(F.col("a").isNotNull()).groupBy("a", "b").agg(F.sum(F.col("first").cast("long")).alias("docs"), F.sum(links).alias("links"))
    # a window's rows are the A ids that one B id meets: no more than A has ids
    return counted.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))


def _give_back(group: pa.Table) -> pa.Table:
    """``block, ord, n_best, count_sum`` of a block's documents from its postings and their pairs' counts."""
    n, size = group.column("n").to_numpy(), group.column("size").to_numpy()
    row, doc = unpacked(group.column("docs"), n, size)
    many = np.int64(1) << group.column("plane").to_numpy().astype(np.int64)
    total, best = np.zeros((2, int(size[0])), np.int64)
    np.add.at(total, doc, (many * group.column("links").to_numpy())[row])
    np.add.at(best, doc, (many * group.column("best").to_numpy(zero_copy_only=False))[row])
    block = group.column("block").to_numpy()[0]
    return pa.table({"block": np.full(len(total), block), "ord": np.arange(len(total), dtype=np.int32), "n_best": best, "count_sum": total})


def align(docs: DataFrame, tokenizers: str = TOKENIZERS, text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``: a row for each row of ``docs``.

    A encodes a space and the text, B the text before which it puts a space itself; special tokens' strings in a text are plain
    text. A text that is null or empty, or that either tokenizer does not give back byte for byte, has no tokens: its
    numbers are 0, its digest is empty, and it counts in no pair. ``n_best`` are links whose pair no other pair of the same B id
    exceeds over the whole corpus, ``count_sum`` adds the corpus-wide count of each link's pair. Rows that repeat are documents
    each, ids may be null, repeat, and be of any type; other columns are left out. No rows give no rows.
    """
    indexed = index(docs, tokenizers, text)
    postings = indexed.where(F.col("a").isNotNull()).select("block", "a", "b", "plane", "n", "size", "docs")
    counts = pair_counts(indexed).select("a", "b", "links", "best")
    given = postings.join(counts, ["a", "b"]).select("block", "plane", "n", "size", "docs", "links", "best").groupBy("block").applyInArrow(_give_back, "block long, ord int, n_best long, count_sum long")
    own = indexed.where(F.col("ord").isNotNull()).select("block", "ord", "doc_id", *_COUNTS, "groups_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return own.join(given, ["block", "ord"], "left").select("doc_id", *_COUNTS, zero("n_best"), zero("count_sum"), "groups_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the two public tokenizers align on every document."""
    return align(table(spark, sf_dir, "documents"))


QUERIES = {"op11_tokenizer_alignment": query}
