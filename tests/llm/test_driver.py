"""How many plans the driver makes: each costs its memory, whatever the size of the tables."""

import random

from blocklake.llm import components, jaccard, mixing
from tests.llm.fixtures import docs, prose
from tests.llm.test_jaccard import brute


def counted(monkeypatch, *modules):
    names = []
    for module in modules:
        monkeypatch.setattr(module, "stored", lambda df, name, f=module.stored: (names.append(name), f(df, name))[1])
    return names


def test_a_round_of_components_is_three_tables(spark, monkeypatch):
    names = counted(monkeypatch, components)
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 300) if i % 60] + [(r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(150)]
    got = {x.v: x.root for x in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {v: v for e in edges for v in e}
    for _ in range(1000):
        before = dict(root)
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    in_edges = {v for a, b in edges if a != b for v in (a, b)}
    assert set(got) == in_edges
    assert len({(got[v], root[v]) for v in in_edges}) == len({got[v] for v in in_edges}) == len({root[v] for v in in_edges})
    rounds = names.count("pointers") // 2
    assert rounds > 1 and len(names) == 1 + 3 * rounds + 1  # five a round before


def test_links_found_after_the_stars_join_what_the_stars_found(spark, monkeypatch):
    """Chains, of which a star finds a part: the second search has components as vertices, not all sets again."""
    rows, k = [], 0
    for chain in range(12):
        words = list(prose(900 + chain, 60, 4000))
        for step in range(9):
            rows.append((k, " ".join(words), "en", "s", 0))
            words[step * 6 % 60] = f"x{chain}y{step}"
            k += 1
    searches = []
    real = components.connected_components
    monkeypatch.setattr(jaccard, "connected_components", lambda edges: (searches.append((edges, found := real(edges))), found)[1])
    got = jaccard.jaccard_components(docs(spark, rows), n_words=2, percent=85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows, 2, 85).elements())
    (_, first), (later, _) = searches
    below = {r.v for r in first.collect() if r.v != r.root}
    assert below and not below & {v for r in later.collect() for v in r}  # it had all links of the stars before


def test_the_join_makes_its_prefixes_once_and_no_table_of_rows_to_read_again(spark, monkeypatch):
    names, plans = [], []
    real = jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, name: (names.append(name), plans.append(df._jdf.queryExecution().optimizedPlan().toString()), real(df, name))[2])
    rows = [(i, " ".join(prose(i // 3, 60, 4000)) + " end" * (i % 3), "en", "s", 0) for i in range(60)]
    got = jaccard.jaccard_components(docs(spark, rows), n_words=2, percent=85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows, 2, 85).elements())
    # before: rows to read again were a table and a count, and each search made the prefixes out of the lists anew
    assert "firsts" not in names and names.count("prefixes") == 1
    assert not [p for n, p in zip(names, plans, strict=True) if n == "near" and "LeftSemi" in p]


def test_rounds_of_a_mix_end_with_one_plan(spark, monkeypatch):
    """Two sources whose room one round fills: a look finds that nothing fits, where a round of five tables did before."""
    names = counted(monkeypatch, mixing)
    rows = [(i, "w " * (20 + i % 7), None, "ab"[i % 2], 0) for i in range(300)]
    sizes = mixing.mix(docs(spark, rows), block_words=300, cycle=(1, 2))[1].collect()
    target, taken = {}, {}
    for r in sizes:
        target[r.source], taken[r.source] = r.target, taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)
    assert names.count("mix-taken") == 1 and names.count("mix-sums") == names.count("mix-crossing") == names.count("mix-room") == 1
