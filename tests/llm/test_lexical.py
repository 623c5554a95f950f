import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from blocklake.llm import lexical
from tests.llm.fixtures import ALNUM, LOWER, corpus, docs


def brute(rows, items, k=10):
    """Every document against every item, in whole numbers."""
    texts = [(r[0], Counter(ALNUM.findall((r[1] or "").translate(LOWER)))) for r in rows]
    texts = [(i, c) for i, c in texts if c]
    n_docs, total = len(texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(ALNUM.findall((t or "").translate(LOWER)))
    out = set()
    for item, terms in wanted.items():
        scored = []
        for i, c in texts:
            n = sum(c.values())
            m = 10 + (90 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out |= {(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)}
    return out


def items(rows):
    whole = [r[1] for r in rows if r[1]]
    own = [t.split() for t in whole if len(t.split()) > 100]
    r = random.Random(5)
    mixed = [" ".join(r.sample(own[j % len(own)], 30) + own[0][:20]) for j in range(20)]
    return [*enumerate([*mixed, "one TWO three", "", None, "known to none", "?!", "Ha", own[-1][0]]), (3, "more terms of an item that is there already"), (None, own[1][3]), (None, own[2][5] + " x"), (90, whole[-1])]


@pytest.mark.parametrize(("k", "limits"), [(10, {}), (3, {"block_bytes": 300})])
def test_search_against_brute_force(spark, monkeypatch, k, limits):
    monkeypatch.setattr(lexical, "CELLS", 1)  # slices of eight documents
    rows = corpus()
    tests = items(rows)
    table = spark.createDataFrame(tests, "item_id long, text string").withColumn("rank", F.lit("own")).withColumn("score", F.lit("own"))
    got = lexical.search(docs(spark, rows).repartition(3).withColumn("score", F.lit(0)), table, k, **limits)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    found = [tuple(r) for r in got.collect()]
    assert Counter((x[0], x[1]) for x in found) == Counter({(x[0], x[1]): 1 for x in found}) and set(found) == brute(rows, tests, k)


def test_ties_go_to_the_least_id_across_tasks(spark):
    rows = [(i, "same text here", None, None, None) for i in range(400)] + [(None, "same text here", None, None, None)] * 3
    tests = [(1, "same"), (2, "here same"), (3, "other")]
    got = lexical.search(docs(spark, rows[::-1]).repartition(5), spark.createDataFrame(tests, "item_id long, text string"), 7)
    assert {tuple(r) for r in got.collect()} == brute(rows, tests, 7)


def test_ids_of_other_types_and_empty_tables(spark):
    rows = [(f"d{i}", t) for i, t in enumerate(["a b c", "a a b", "c", "", None, "é a"])]
    table = spark.createDataFrame(rows, "doc_id string, text string")
    tests = spark.createDataFrame([("x", "a c"), ("y", "É é")], "item_id string, text string")
    assert {tuple(r) for r in lexical.search(table, tests).collect()} == brute(rows, [("x", "a c"), ("y", "É é")])
    assert lexical.search(table.limit(0), tests).count() == 0
    assert lexical.search(table, tests.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_shared_sums_are_those_of_the_terms(seed):
    r = np.random.default_rng(seed)
    n_terms, n_queries = 60, 40
    base = r.permutation(n_terms)[:15]
    sets = [np.unique(np.r_[base[: r.integers(0, 15)], r.integers(0, n_terms, r.integers(0, 25))]) for _ in range(n_queries)]
    bounds = np.r_[0, np.cumsum([len(s) for s in sets])]
    shared = lexical.mine(np.concatenate(sets), bounds, n_terms)
    below = [{t} for t in range(n_terms)]
    for left, right in shared.levels:
        below += [below[a] | below[b] for a, b in zip(left, right, strict=True)]
    assert [set().union(*[below[x] for x in shared.nodes[a:b]]) for a, b in zip(shared.first[:-1], shared.first[1:], strict=True)] == [set(s) for s in sets]
    additions = len(shared.nodes) + sum(len(a) for a, _ in shared.levels)
    assert additions < 0.8 * bounds[-1] and len(shared.levels) > 1  # nodes are shared, and nodes of nodes
    values = r.integers(1, 1 << 40, (n_terms, 9)) * (r.random((n_terms, 9)) < 0.2)
    t, d = np.nonzero(values)
    queries, scores = lexical.sums(shared, t, d, values[t, d], 9)
    full = np.zeros((n_queries, 9), np.int64)
    full[queries] = scores
    assert (full == np.array([values[s].sum(axis=0) if len(s) else np.zeros(9, np.int64) for s in sets])).all()


def test_no_two_queries_share_anything():
    shared = lexical.mine(np.array([0, 1, 2, 3]), np.array([0, 2, 2, 4]), 4)
    assert not shared.levels and shared.first.tolist() == [0, 2, 2, 4]
    empty = lexical.mine(np.zeros(0, np.int64), np.array([0]), 0)
    assert empty.size == 0 and lexical.sums(empty, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 3)[0].size == 0


def test_damping_beyond_64_bits():
    n = np.array([1, 10**9, 10**12], np.int64)
    assert lexical.damping(n, 10**11, 10**14).tolist() == [10 + 90 * int(x) * 10**11 // 10**14 for x in n]
