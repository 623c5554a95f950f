import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from blocklake.llm import sharding as S
from blocklake.llm.common import shared_dir
from tests.llm.fixtures import DOCS, docs


def table(spark, n, parts, start=0):
    return spark.createDataFrame([(start + i, "x" * 50, "en", "s", 0) for i in range(n)], DOCS).repartition(parts)


def rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_arrivals_are_merged_by_tier_and_nothing_is_lost(spark):
    root = f"{shared_dir(spark)}/lake1"
    assert S.current_version(spark, root) == 0 and S.manifest(spark, root).count() == 0
    one, two = table(spark, 400, 8), table(spark, 100, 1, 1000)
    assert S.append(one, root) == 1 and S.append(two, root) == 2
    before = S.manifest(spark, root).collect()
    assert sum(r.n_docs for r in before) == 500 and sum(r.n_bytes for r in before) == 25_000
    assert S.compact(spark, root, one.schema, target=12_000) == 3
    after = S.manifest(spark, root).collect()
    assert len(after) < len(before) and sum(r.n_bytes for r in after) == 25_000 and max(r.n_bytes for r in after) < 24_000
    got = S.read_shards(spark, root, one.schema)
    assert rows(got) == rows(one.unionByName(two)) and got.select("shard").distinct().count() == len(after)
    assert rows(S.read_shards(spark, root, one.schema, 1)) == rows(one)  # old versions can be read until they are vacuumed
    assert S.vacuum(spark, root) > 0 and rows(S.read_shards(spark, root, one.schema)) == rows(one.unionByName(two))
    assert S.compact(spark, root, one.schema, target=100) == 3  # nothing to merge, no new version


def test_many_shards_are_read_by_folder(spark, monkeypatch):
    monkeypatch.setattr(S, "MOST_SENT", 2)
    root, one = f"{shared_dir(spark)}/lake5", table(spark, 400, 8)
    S.append(one, root)
    S.append(table(spark, 300, 1, 1000), root)
    assert S.compact(spark, root, one.schema, target=12_000) == 3
    assert rows(S.read_shards(spark, root, one.schema)) == rows(one.unionByName(table(spark, 300, 1, 1000)))
    assert rows(S.read_shards(spark, root, one.schema, 1)) == rows(one)


def test_only_similar_sizes_meet(spark):
    sizes = [(f"s{i}", "data/x", False, 1, n) for i, n in enumerate([10, 11, 12, 13, 500, 510, 60_000, 300])]
    plan = S.plan_merges(spark.createDataFrame(sizes, S.MANIFEST), target=100_000).collect()
    by_run = {}
    for r in plan:
        by_run.setdefault(r.run, []).append(r.n_bytes)
    assert by_run.pop(None) == [60_000]
    assert all(max(x) <= 4 * min(x) for x in by_run.values()) and sorted(map(len, by_run.values())) == [3, 4]


@pytest.mark.parametrize("seed", range(2))
def test_the_plan_against_brute_force(spark, seed):
    r = random.Random(seed)
    target, base = 10_000, 4
    sizes = {f"s{i:03d}": r.choice([0, r.randrange(1, 40), r.randrange(500), r.randrange(9000)]) for i in range(120)}
    got = {x["shard"]: x["run"] for x in S.plan_merges(spark.createDataFrame([(k, "f", False, 1, n) for k, n in sizes.items()], S.MANIFEST), target, base).collect()}
    tiers = defaultdict(list)
    for k, n in sizes.items():
        if 2 * n < target:
            tiers[next(t for t in range(20) if max(n, 1) < base ** (t + 1))].append((n, k))
    want = set()
    for own in tiers.values():
        parts, before = defaultdict(list), 0
        for n, k in sorted(own):
            parts[before // target].append(k)
            before += n
        want |= {frozenset(p) for p in parts.values() if len(p) > 1}
    runs = defaultdict(set)
    for k, run in got.items():
        runs[run].add(k)
    runs.pop(None, None)
    assert {frozenset(x) for x in runs.values()} == want and want


def test_a_version_is_committed_once(spark):
    root = f"{shared_dir(spark)}/lake2"
    S.append(table(spark, 5, 1), root)
    with pytest.raises(S.CommitConflict):
        S.commit(spark, root, S.manifest(spark, root), 1)
    assert S.current_version(spark, root) == 1 and S.manifest(spark, root).count() == 1


def test_a_commit_that_broke_off_is_not_there(spark):
    root = f"{shared_dir(spark)}/lake3"
    S.append(table(spark, 5, 1), root)
    S.manifest(spark, root).write.parquet(f"{root}/manifests/new-left-behind")  # written, never renamed
    assert S.current_version(spark, root) == 1 and S.append(table(spark, 5, 1, 10), root) == 2
    assert S.read_shards(spark, root, table(spark, 1, 1).schema).count() == 10


def test_writers_that_race(spark, monkeypatch):
    """Another append and another compaction are committed while ours is on its way."""
    root, one = f"{shared_dir(spark)}/lake4", table(spark, 60, 6)
    S.append(one, root)
    real, raced = S.current_version, []

    def late(spark_, root_):
        version = real(spark_, root_)
        if not raced:
            raced.append(1)
            S.append(table(spark, 7, 1, 500), root)
        return version

    monkeypatch.setattr(S, "current_version", late)
    assert S.append(table(spark, 9, 1, 700), root) == 3
    assert S.read_shards(spark, root, one.schema).count() == 76
    raced.clear()
    monkeypatch.setattr(S, "current_version", lambda *a: (real(*a)))
    plan, done = S.plan_merges, []

    def planned(entries, *a):
        if not done:
            done.append(1)
            S.append(table(spark, 11, 1, 900), root)
        return plan(entries, *a)

    monkeypatch.setattr(S, "plan_merges", planned)
    assert S.compact(spark, root, one.schema, target=100_000) == 5  # on top of the append
    assert rows(S.read_shards(spark, root, one.schema)).total() == 87
    done.clear()

    def merged_before(entries, *a):
        out = plan(entries, *a)
        if not done:
            done.append(1)
            S.compact(spark, root, one.schema, target=200_000)
        return out

    S.append(table(spark, 3, 1, 990), root)
    S.append(table(spark, 3, 1, 995), root)
    monkeypatch.setattr(S, "plan_merges", merged_before)
    with pytest.raises(S.CommitConflict):
        S.compact(spark, root, one.schema, target=100_000)
    assert rows(S.read_shards(spark, root, one.schema)).total() == 93


def test_hard_rows_and_empty(spark):
    hard = docs(spark).withColumn("run", F.lit("own")).withColumn("size", F.lit(7)).withColumn("folder", F.lit("mine"))
    got = S.shard(hard.withColumnRenamed("spans", "version"), target=1000)
    assert rows(got) == rows(hard) and {"shard", "version"} <= set(got.columns)
    own = S.shard(hard.withColumn("shard", F.lit("s")), target=1000, names=("in", "of"))
    assert {(r.run, r.size, r.folder, r.shard) for r in own.collect()} == {("own", 7, "mine", "s")} and rows(own) == rows(hard)
    assert S.shard(docs(spark, [])).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the given tables")
def test_query_adds_up(spark):
    got = S.query(spark, "/root/testdata/sf0.001").collect()
    docs_ = {r.doc_id: len((r.text or "").encode()) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {r.doc_id: r.n_bytes for r in got} == docs_ and len(got) == len(docs_) and len({r.version for r in got}) == 1
    shards = defaultdict(list)
    for r in got:
        shards[r.shard_id, r.shard_docs, r.shard_bytes].append(r)
    for (least, n, size), own in shards.items():
        assert least == min(r.doc_id for r in own) and n == len(own) and size == sum(r.n_bytes for r in own)
