import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from blocklake.llm.substring import count_windows, dedup_substrings
from blocklake.llm.suffixes import GRAM, HOT, Run, bounds_of, common, dedup_bytes, merge, united
from tests.llm.fixtures import DOCS, corpus, docs


def brute(texts, n):
    """Marks of removed values for each text."""
    seen = Counter(tuple(t[i : i + n]) for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - n + 1):
            if seen[tuple(t[i : i + n])] > 1:
                gone[i : i + n] = [True] * n
        out.append(gone)
    return out


def words(rows):
    return [(r[1] or "").encode().split() for r in rows]


@pytest.mark.parametrize(("window", "gram", "hot"), [(35, 10, 20_000), (35, 10, 3), (8, 3, 20_000), (8, 3, 2)])
def test_words_against_brute_force(spark, window, gram, hot):
    rows = corpus()
    want = Counter()
    for r, w, gone in zip(rows, words(rows), brute(words(rows), window), strict=True):
        want[r[0], len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()] += 1
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in dedup_substrings(docs(spark), window=window, gram=gram, hot=hot).collect())
    assert got == want


@pytest.mark.parametrize(("length", "gram", "hot"), [(200, GRAM, HOT), (200, GRAM, 4), (200, 48, 1), (20, 6, HOT), (20, 6, 3)])
def test_bytes_against_brute_force(spark, length, gram, hot):
    rows = corpus()
    texts = [(r[1] or "").encode() for r in rows]
    want = Counter()
    for r, t, gone in zip(rows, texts, brute(texts, length), strict=True):
        spans = united([(i, i + 1) for i, g in enumerate(gone) if g])
        want[r[0], len(t), sum(gone), tuple(spans), bytes(b for b, g in zip(t, gone, strict=True) if not g)] += 1
    found = dedup_bytes(docs(spark), length=length, gram=gram, hot=hot, per_range=100).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in found) == want


@pytest.mark.parametrize("seed", range(4))
def test_bytes_of_random_small_alphabets(spark, seed):
    r = random.Random(seed)
    rows = [(i, "".join(r.choices("ab", k=r.randrange(0, 90))), None, None, None) for i in range(40)]
    texts = [x[1].encode() for x in rows]
    want = {i: sum(g) for i, g in enumerate(brute(texts, 12))}
    got = dedup_bytes(spark.createDataFrame(rows, DOCS), length=12, gram=5, hot=[6, HOT][seed % 2], per_range=50).collect()
    assert {x.doc_id: x.n_removed for x in got} == want


def test_ids_of_other_types_and_extremes(spark):
    rows = corpus()
    table = docs(spark, rows).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    want = Counter((None if r[0] is None else f"d{r[0]}", sum(g)) for r, g in zip(rows, brute(words(rows), 35), strict=True))
    assert Counter((r.doc_id, r.n_removed) for r in dedup_substrings(table).collect()) == want
    want = Counter((None if r[0] is None else f"d{r[0]}", sum(g)) for r, g in zip(rows, brute([(r[1] or "").encode() for r in rows], 200), strict=True))
    assert Counter((r.doc_id, r.n_removed) for r in dedup_bytes(table).collect()) == want
    least = spark.createDataFrame([(-(1 << 63), "a b", None, None, None), (None, "a b", None, None, None)], DOCS)
    assert {r.doc_id for r in dedup_substrings(least).collect()} == {r.doc_id for r in dedup_bytes(least).collect()} == {-(1 << 63), None}


def test_bounds_share_the_places():
    sample = [(bytes([i]), 1 + i % 3) for i in range(200)]
    cuts = bounds_of(sample[::-1], 10)
    sums = Counter(sum(c <= g for c in cuts) for g, n in sample for _ in range(n))
    assert cuts == sorted(cuts) and len(cuts) == 9 and max(sums.values()) <= 2 * min(sums.values())
    assert bounds_of([], 5) == []


def test_empty(spark):
    assert dedup_substrings(docs(spark, [])).count() == 0 and dedup_bytes(docs(spark, [])).count() == 0


def coded(suffixes):
    last, shared, rest = b"", [], []
    for s in suffixes:
        n = common(last, s)
        shared.append(n)
        rest.append(s[n:])
        last = s
    return Run(shared, rest, [b""] * len(rest), [[s] for s in suffixes])


def test_loser_tree_merges_in_order_with_exact_common_prefixes():
    r = random.Random(3)
    for k in (1, 2, 3, 7, 8):
        lists = [sorted(bytes(r.choices(b"ab", k=r.randrange(1, 40))) for _ in range(r.randrange(1, 30))) for _ in range(k)]
        out = list(merge([coded(x) for x in lists]))
        assert [s for _, s, _, _ in out] == sorted(s for x in lists for s in x)
        assert [n for n, *_ in out[1:]] == [common(a[1], b[1]) for a, b in zip(out, out[1:], strict=False)]


def test_common_prefix():
    r = random.Random(4)
    for _ in range(300):
        a, b = (bytes(r.choices(b"ab", k=r.randrange(0, 12))) * r.randrange(1, 9) for _ in "ab")
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert common(a, b) == n == common(a, b, n // 2)


def test_count_windows():
    a, b = b"a b c d e f", b"x b c d e y"
    assert dict(count_windows({1: (a, 1), 2: (b, 1)}, 3)) == {1: [(1, 2)], 2: [(1, 2)]}
    assert dict(count_windows({1: (a, 2)}, 3)) == {1: [(0, 3)]}
    assert dict(count_windows({1: (a, 1)}, 3)) == {}
