from collections import Counter, defaultdict
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from blocklake.llm.mixing import hypergeometric, lined_up, mix, split_quotas, with_targets
from tests.llm.fixtures import corpus, docs, spaced


def brute_targets(sizes, cap=3):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > cap * sizes[s]}
        if not over:
            return {**{s: float(cap * sizes[s]) for s in capped}, **share}
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1, None: 50}, {"a": 5}, {"b": 0, "a": 7}, {f"s{i}": (i * 7919) % 97 for i in range(30)}])
def test_targets_are_the_fixed_point(spark, sizes):
    got = {r.source: r.target for r in with_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = brute_targets(sizes)
    assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_tree_deals_every_quota_and_even_shards(spark):
    quotas = {"a": 37, "b": 100, "c": 1, "d": 3}
    rows = split_quotas(spark.createDataFrame(list(quotas.items()), "source string, quota long"), 3, 5).collect()
    total, shards = defaultdict(int), defaultdict(int)
    for r in rows:
        total[r.source] += r.n
        shards[r.shard] += r.n
    assert dict(total) == quotas and len(shards) == 8 and max(shards.values()) - min(shards.values()) <= 3


def test_draws_follow_the_hypergeometric_law(spark):
    """The number drawn is the one at which the exact distribution function passes u."""
    cases = [(40, 10, 20), (7, 3, 5), (1000, 400, 10), (5000, 4990, 2500), (60, 1, 30), (9, 9, 4), (12, 0, 3), (30, 12, 0), (30, 12, 30)]
    rows = [(n, q, d, (i + 0.5) / 37) for n, q, d in cases for i in range(37)]
    table = spark.createDataFrame([*rows, (200_000_000, 70_000_000, 100_000_000, 0.37)], "n long, q long, d long, u double")
    got = {(r.n, r.q, r.d, r.u): r.k for r in table.withColumn("k", hypergeometric(F.col("n"), F.col("q"), F.col("d"), F.col("u"))).collect()}
    huge = got.pop((200_000_000, 70_000_000, 100_000_000, 0.37))
    assert abs(huge - 35_000_000) < 5 * (100e6 * 0.35 * 0.65 * 0.5) ** 0.5
    for n, q, d in cases:
        chance = {k: Fraction(comb(q, k) * comb(n - q, d - k), comb(n, d)) for k in range(max(0, d + q - n), min(q, d) + 1)}
        mode = max(chance, key=lambda k: (chance[k], -k))
        for i in range(37):
            k = got[n, q, d, (i + 0.5) / 37]
            # outwards from the mode, one above, one below
            order = [mode, *[mode + s * j for j in range(1, n + 1) for s in (1, -1)]]
            sums, u = Fraction(0), Fraction((i + 0.5) / 37)
            for x in order:
                sums += chance.get(x, 0)
                if u < sums:
                    break
            assert abs(k - x) <= (0 if chance[mode] != chance.get(mode + 1) else 1), (n, q, d, i, k, x)


def test_every_node_of_the_tree_draws_by_the_law(spark):
    """Means, variances and covariances of the sources' blocks over the nodes of three levels of one tree of 4096 blocks."""
    quotas = {"a": 640, "b": 1536, "c": 1920}
    rows = split_quotas(spark.createDataFrame(list(quotas.items()), "source string, quota long"), 8, 3).collect()
    got = {(r.source, r.shard): r.n for r in rows}
    for level in (8, 7, 6):
        size = 4096 >> level
        nodes = {s: [sum(got.get((s, leaf), 0) for leaf in range(k << 8 - level, k + 1 << 8 - level)) for k in range(1 << level)] for s in quotas}
        assert all(sum(n[k] for n in nodes.values()) == size for k in range(1 << level))
        for s, q in quotas.items():
            p, left = q / 4096, (4096 - size) / 4095
            variance = sum((x - size * p) ** 2 for x in nodes[s]) / len(nodes[s])
            assert 0.6 < variance / (size * p * (1 - p) * left) < 1.5, (level, s)
        both = sum((x - size * 640 / 4096) * (y - size * 1536 / 4096) for x, y in zip(nodes["a"], nodes["b"], strict=True)) / (1 << level)
        assert -1.7 < both / (size * 640 / 4096 * 1536 / 4096 * left) < -0.4, level


def test_ranks_over_stretches(spark):
    rows = [(k, i // 7, (i * 37) % 100, i % 5) for k in "ab" for i in range(60)]
    df = spark.createDataFrame(rows, "k string, stretch0 long, x long, size long").withColumn("o", F.col("stretch0") * 1000 + F.col("x"))
    out = lined_up(df, "k", F.col("stretch0"), ["o"], "test", "size").collect()
    for key in "ab":
        mine = sorted((r for r in out if r.k == key), key=lambda r: r.o)
        assert [r["rank"] for r in mine] == list(range(60)) and [r.before for r in mine] == [sum(x["size"] for x in mine[:i]) for i in range(60)]


def test_mix_meets_targets_and_repeats(spark):
    rows = [*corpus(), *[(1000 + i, " ".join(["w"] * (5 + i % 40)), "en", f"s{i % 5}", 0) for i in range(300)]]
    table = docs(spark, rows)
    draws, sizes = mix(table, block_words=300, shard_words=2000)
    got = sizes.collect()
    assert len(got) == len(rows) and Counter((r.doc_id, r.size) for r in got) == Counter((x[0], len(spaced(x[1]))) for x in rows)
    by_source = defaultdict(int)
    for x in rows:
        by_source[x[3]] += len(spaced(x[1]))
    want, taken = brute_targets(by_source), defaultdict(int)
    for r in got:
        assert r.source_size == by_source[r.source] and abs(r.target - want[r.source]) < 1e-6 and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in want:
        assert abs(taken[s] - want[s]) <= max(5, 0.02 * want[s]), s
    drawn = draws.groupBy("source").agg(F.count("*").alias("n")).collect()
    assert sum(r.n for r in drawn) == draws.count()
    words = {(r.doc_id, r.th): r.size for r in got}
    assert sum(words[r.doc_id, r.th] for r in draws.collect()) == sum(taken.values())
    again = mix(table, block_words=300, shard_words=2000)[1].collect()
    assert Counter(map(str, again)) == Counter(map(str, got))
    assert sorted((r.doc_id or 0, p.shard, p.position) for r in got for p in r.places) == sorted((r.doc_id or 0, r.shard, r.position) for r in draws.collect())
    seats = draws.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("position").alias("d"), F.max("position").alias("m")).collect()
    assert len(seats) > 1 and all(r.n == r.d == r.m + 1 for r in seats)


@pytest.mark.parametrize("long", [[5000], [3000, 2500]])
def test_long_documents_leave_no_source_short(spark, long):
    """Texts longer than a block and than the target: what fits is looked for in all blocks, whatever their order."""
    rows = [(i, "w " * n, None, "a", 0) for i, n in enumerate([*long, *[20 + i % 7 for i in range(218)]])]
    rows += [(1000 + i, "w " * n, None, "b", 0) for i, n in enumerate([*[17] * 5, *[40] * 73])]
    for seed in range(2):
        draws, sizes = mix(docs(spark, rows), block_words=300, cycle=(1, 2), seed=seed)
        target, taken = {}, Counter()
        for r in sizes.collect():
            target[r.source] = r.target
            taken[r.source] += r.taken
        assert max(long) > 300 and all(abs(taken[s] - target[s]) <= 20 for s in target), (seed, target, taken)


def test_empty(spark):
    draws, sizes = mix(docs(spark, []))
    assert draws.count() == 0 and sizes.count() == 0
