import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from blocklake.llm import jaccard
from blocklake.llm.components import connected_components
from tests.llm.fixtures import LOWER, corpus, docs, spaced


def brute(rows, n, percent):
    sets = []
    for r in rows:
        w = spaced((r[1] or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            m = len(a & sets[j])
            if a and 100 * m >= percent * (len(a) + len(sets[j]) - m) and m:
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows))


def near(seed, copies, length, most):
    """A dense group: copies of one text with up to ``most`` edits, many far from each other."""
    r = random.Random(seed)
    base = [f"b{r.randrange(9999)}" for _ in range(length)]
    for k in range(copies):
        w = list(base)
        for _ in range(r.randrange(most)):
            w[r.randrange(length)] = f"e{k}x{r.randrange(99)}"
        yield (10_000 * seed + k, " ".join(w), "en", "s", 0)


@pytest.mark.parametrize(("n", "percent", "boundary"), [(4, 85, None), (5, 80, 1), (1, 60, 10_000), (4, 85, 60)])
def test_components_against_brute_force(spark, monkeypatch, n, percent, boundary):
    monkeypatch.setattr(jaccard, "COMMON", 6)
    if boundary:
        monkeypatch.setattr(jaccard, "choose_boundary", lambda *_: boundary)
    rows = [*corpus(), *near(1, 60, 40, 8), *near(2, 40, 150, 14)]
    if boundary == 10_000:
        rows = [r for r in rows if len(spaced(r[1])) < 200]
    got = jaccard.jaccard_components(docs(spark, rows), n_words=n, percent=percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, n, percent)


def test_empty(spark):
    assert jaccard.jaccard_components(docs(spark, [])).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.v: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(41)}) == 1 and len({got[i] for i in range(100, 130)}) == 1 and got[199] == got[200]
    assert len({got[0], got[100], got[199]}) == 3


def test_ids_of_other_types_and_many_unlike_sets_of_one_list(spark):
    """Ids as text; short sets of all sizes that share a run of words and little else."""
    r = random.Random(9)
    rows = [(i, " ".join(["one", "line", "they", "all", "have", *(f"u{i}x{k}" for k in range(i % 23))]), "en", "s", 0) for i in range(160)]
    rows += [(500 + i, " ".join([*(f"v{k}" for k in range(30)), *(["end"] * (r.random() < 0.5)), f"w{i // 2}"]), "en", "s", 0) for i in range(40)]
    table = docs(spark, rows).withColumn("doc_id", F.format_string("d%04d", "doc_id"))
    got = jaccard.jaccard_components(table, n_words=2, percent=70).collect()
    assert Counter((int(x.doc_id[1:]), x.n_shingles, int(x.component_id[1:])) for x in got) == brute(rows, 2, 70)


def test_equal_sets_alone_link_at_a_hundred_percent(spark):
    rows = [(1, "a b c d e", None, None, 0), (2, "a b c d e", None, None, 0), (3, "a b c d f", None, None, 0), (-(1 << 63), "x y z", None, None, 0), (None, "x y z", None, None, 0)]
    got = jaccard.jaccard_components(docs(spark, rows), n_words=2, percent=100).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter([(1, 1), (2, 1), (3, 3), (-(1 << 63), -(1 << 63)), (None, -(1 << 63))])


def test_unlike_sets_that_share_a_hash_are_told_apart(spark, monkeypatch):
    whole = jaccard._identity
    monkeypatch.setattr(jaccard, "_identity", lambda *a: (whole(*a)[0] % np.uint64(7), whole(*a)[1]))
    rows = [*corpus(), *near(3, 20, 40, 8)]
    got = jaccard.jaccard_components(docs(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 4, 85)


@pytest.mark.parametrize("boundary", [1, 10_000])
def test_texts_of_one_template_that_are_just_too_unlike_are_in_no_pair(spark, monkeypatch, boundary):
    """Similarity 0.81 throughout but for a few pairs: what the lists hold grows with the texts, not with their pairs."""
    monkeypatch.setattr(jaccard, "choose_boundary", lambda *_: boundary)
    monkeypatch.setattr(jaccard, "COMMON", 6)
    template = [f"t{k}" for k in range(90)]
    rows = [(i, " ".join(template + [f"o{i}x{k}" for k in range(10)]), None, None, 0) for i in range(150)]
    rows += [(200 + i, " ".join(template + [f"o{i}x{k}" for k in range(8)] + ["y", "z"]), None, None, 0) for i in range(3)]
    written = {}
    keep = jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, name: written.setdefault(name, keep(df, name)))
    got = jaccard.jaccard_components(docs(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 4, 85)
    assert written["lists"].count() < 200 * len(rows) and written["open"].count() < 1000 and written["near"].count() < 200
