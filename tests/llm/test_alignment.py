import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from blocklake.llm import alignment
from tests.llm.fixtures import corpus, docs

BYTE_BPE, PIECE_BPE = (f"{alignment.TOKENIZERS}/{n}" for n in (alignment.BYTE_BPE, alignment.PIECE_BPE))
HARD = [
    "<|endoftext|> in a text, <s> and </s> <0x41> <unk>", "a▁b c", "▁ ▁", " ", "  leading", "trailing  ", "\n\n\tx  y   z\r\n", "ﬁ Ⅳ ① é é", "日本語 テキスト。", "😀😀 👨‍👩‍👧 🇫🇷", "\u00a0 \u00a0x \u3000 y\u2003 z", "it's we'll 'tis n't", "\x00 \x1c \x85 x",
    "१२३ ٣٤٥ 12345 3.14", "x" * 3000, "ab " * 2000, "$$$ ### !!!", "ÀÉ ß ſ", "\u200b \u180e \u2028x",
]


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
    return a, b, sign


def brute(rows, coders):
    """Whole texts, byte ranges of every token, every pair of tokens of a group."""
    a, b, sign = coders
    out, pairs, held = [], Counter(), Counter()
    for i, text in rows:
        line, links, ids, groups = (" " + (text or "")).encode(), [], [[], []], []
        if text:
            spans = [[], []]
            for k, tokens in enumerate(([(t, bytes(sign[c] for c in a.id_to_token(t))) for t in a.encode(" " + text, add_special_tokens=False).ids], [(t, bytes([int(b.id_to_piece(t)[3:5], 16)]) if b.is_byte(t) else b.id_to_piece(t).replace("▁", " ").encode()) for t in b.encode(text)])):
                at = 0
                for t, x in tokens:
                    spans[k].append((at, at + len(x), t))
                    at += len(x)
                ids[k] = b"".join(x for _, x in tokens)
            if ids[0] == line and ids[1] == line:
                cuts = sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]})
                start = 0
                for cut in cuts:
                    ga, gb = ([s for s in side if start <= s[0] and s[1] <= cut] for side in spans)
                    groups.append(",".join(str(s[2]) for s in ga) + "|" + ",".join(str(s[2]) for s in gb))
                    links += [(x[2], y[2]) for x in ga for y in gb if x[0] < y[1] and y[0] < x[1]]
                    start = cut
                out.append((i, len(spans[0]), len(spans[1]), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        if not groups:
            out.append((i, 0, 0, 0, [], ""))
        pairs.update(links)
        held.update(set(links))
    most = Counter()
    for (_, y), n in pairs.items():
        most[y] = max(most[y], n)
    return Counter((i, na, nb, ng, len(x), sum(pairs[p] == most[p[1]] for p in x), sum(pairs[p] for p in x), sha) for i, na, nb, ng, x, sha in out), pairs, held, most


def texts():
    r = random.Random(7)
    signs = ["a", "b", "the", "'s", "'", "é", " ", "  ", "\n", "\t", "\u00a0", "1", "23", "!", "#", "▁", "<s>", "\x1c", "ing", "😀", "\u200b", "ﬁ", "\u0308", "\u1680"]
    return [*HARD, *["".join(r.choice(signs) for _ in range(r.randrange(1, 25))) for _ in range(150)]]


@pytest.mark.parametrize(("block_bytes", "block_docs"), [(4 << 20, 1 << 16), (700, 1 << 16), (1 << 20, 9)])
def test_align_against_brute_force(spark, monkeypatch, coders, block_bytes, block_docs):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(alignment, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(alignment, "MOST_KNOWN", 300)  # several beginnings anew in a task
    rows = [*[(r[0], r[1]) for r in corpus()], *[(1000 + i, t) for i, t in enumerate(texts())]]
    table = docs(spark, [(*r, None, None, None) for r in rows]).repartition(3).withColumn("block", F.lit("own")).withColumn("n", F.lit(1)).withColumn("docs", F.lit(1))
    got = alignment.align(table)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want, pairs, held, most = brute(rows, coders)
    assert Counter(tuple(r) for r in got.collect()) == want
    counts = alignment.pair_counts(alignment.index(table)).collect()
    assert {(r.a, r.b): (r.links, r.docs, r.best) for r in counts} == {p: (n, held[p], n == most[p[1]]) for p, n in pairs.items()}


def test_nothing_to_align(spark):
    table = spark.createDataFrame([("x", None), ("y", ""), (None, "▁")], "doc_id string, text string")
    assert sorted((r.doc_id or "", *r[1:]) for r in alignment.align(table).collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i in ("", "x", "y")]
    assert alignment.align(table.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 7, 300, 60000])
def test_bitmaps_come_back(size):
    r = np.random.default_rng(size)
    sets = [np.flatnonzero(r.random(size) < p) for p in (0, 0.001, 0.05, 0.5, 1)] + [np.array([size - 1])]
    row, doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
    n = np.array([len(s) for s in sets])
    made = alignment.packed(row, doc, len(sets), size)
    assert all(len(x.as_py()) <= max(2, -(-size // 8)) for x in made)
    for whole in (made, pa.chunked_array([made.slice(0, 2), made.slice(2)]), pa.concat_arrays([made, made]).slice(len(sets))):
        back = unordered(*alignment.unpacked(whole, n, np.full(len(sets), size)))
        assert back == unordered(row, doc)


def unordered(row, doc):
    return sorted(zip(row.tolist(), doc.tolist(), strict=True))


def test_planes_hold_multiplicities():
    r = np.random.default_rng(1)
    pair, doc = np.divmod(np.unique(r.integers(0, 40 * 50, 900)), 50)
    times = r.integers(1, 1000, len(pair))
    rows = alignment.planes(pair, doc, times, 50, 7)
    n, size, plane = (rows.column(c).to_numpy() for c in ("n", "size", "plane"))
    key = (rows.column("a").to_numpy() * 7 + rows.column("b").to_numpy())
    at, d = alignment.unpacked(rows.column("docs"), n, size)
    total = Counter()
    for k, x in zip(at.tolist(), d.tolist(), strict=True):
        total[int(key[k]), x] += 1 << int(plane[k])
    assert total == Counter({(int(p), int(x)): int(t) for p, x, t in zip(pair, doc, times, strict=True)})
    first = Counter()
    for k, f in zip(key.tolist(), rows.column("first").to_pylist(), strict=True):
        first[k] += f
    assert first == Counter(pair.tolist())
