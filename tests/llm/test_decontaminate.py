from collections import Counter

import pytest
from pyspark.sql import functions as F

from blocklake.llm import decontaminate as decontaminate_module
from blocklake.llm.decontaminate import decontaminate, matches
from tests.llm.fixtures import ALNUM, LOWER, corpus, docs


def items(rows):
    own = [r[1].split() for r in rows if r[1] and len(r[1].split()) > 150]
    passages = [" ".join(own[1][20:60]), " ".join(own[-1][100:112]).upper(), " ".join(own[2][:9]), "one", "two, words!", "", None, "never seen in any of the texts here at all, not once", " ".join(own[1][30:50])]
    return [*enumerate(passages), (3, "one"), (None, "three more words"), (10, "x y " * 20)]


def brute(rows, tests, n):
    windows = {}
    for i, t in tests:
        w = ALNUM.findall((t or "").translate(LOWER))
        if w and i is not None:
            size = min(n, len(w))
            for k in range(len(w) - size + 1):
                windows.setdefault(tuple(w[k : k + size]), set()).add(i)
    out = Counter()
    for r in rows:
        w, hit, found = ALNUM.findall((r[1] or "").translate(LOWER)), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                who = windows.get(tuple(w[k : k + size]))
                if who:
                    hit.update(range(k, k + size))
                    found |= who
        out[r[0], len(w), len(hit), tuple(sorted(found))] += 1
    return out


@pytest.mark.parametrize(("window", "block_bytes", "blocks"), [(10, 1 << 24, 8), (10, 400, 8), (10, 400, 1), (3, 1 << 24, 8)])
def test_hits_against_brute_force(spark, monkeypatch, window, block_bytes, blocks):
    monkeypatch.setattr(decontaminate_module, "BLOCKS", blocks)
    rows = corpus()
    tests = items(rows)
    table = spark.createDataFrame(tests, "item_id long, text string")
    got = matches(docs(spark), table, window, block_bytes=block_bytes).collect()
    assert Counter((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), tuple(r.items)) for r in got) == brute(rows, tests, window)
    for r in got:
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False)) and (r.longest > 0) == bool(r.spans)


def test_longest_match_and_removal(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, f"start {passage} end", "en", "s", 0), (2, "clean text of its own", "en", "s", 0), (3, None, "en", "s", 0), (None, passage, "en", "s", 0), (None, "clean as well", "en", "s", 0)]
    table = spark.createDataFrame([(5, f"x y {passage} z")], "item_id long, text string")
    got = {(r.doc_id, r.th): r for r in matches(docs(spark, rows), table).collect()}
    assert sorted(r.longest for r in got.values()) == [0, 0, 0, 30, 30]
    one = next(r for r in got.values() if r.doc_id == 1)
    assert [(s.start, s.end) for s in one.spans] == [(1, 31)]
    left = decontaminate(docs(spark, rows), table)
    assert left.columns == docs(spark, rows).columns and Counter((r.doc_id, r.text) for r in left.collect()) == Counter((r[0], r[1]) for r in (rows[1], rows[2], rows[4]))


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert matches(docs(spark, []), none).count() == 0
    assert matches(docs(spark), none).where("size(spans) > 0").count() == 0


def test_clashing_columns_and_ids_of_other_types(spark):
    rows = corpus()
    table = docs(spark, rows).withColumn("_id", F.lit("own")).withColumn("_th", F.lit("too")).withColumn("doc_id", F.col("doc_id").cast("string"))
    tests = spark.createDataFrame(items(rows), "item_id long, text string")
    found = {(r.doc_id, r.th) for r in matches(table, tests).collect() if r.spans}
    kept = decontaminate(table, tests).collect()
    assert {(r["_id"], r["_th"]) for r in kept} == {("own", "too")} and found
    clean = Counter((r.doc_id, r.text) for r in kept)
    assert clean == Counter((r.doc_id, r.text) for r in table.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect() if (r.doc_id, r.h) not in found)


@pytest.mark.parametrize("kind", ["string", "int", "decimal(20,0)", "date"])
def test_item_ids_of_any_type(spark, kind):
    rows, tests = corpus(), items(corpus())
    table = spark.createDataFrame(tests, "item_id long, text string")
    typed = table.withColumn("item_id", typed_column(kind)).withColumn("number", F.lit("own"))
    ids = {r.item_id: r.typed for r in table.withColumn("typed", typed_column(kind)).collect()}
    got = matches(docs(spark), typed, block_bytes=400)
    want = Counter({(i, w, h, tuple(sorted(ids[x] for x in found))): n for (i, w, h, found), n in brute(rows, tests, 10).items()})
    assert Counter((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), tuple(r.items)) for r in got.collect()) == want
    assert decontaminate(docs(spark), typed).count() == sum(n for (_, _, h, _), n in want.items() if not h)
    assert matches(docs(spark), typed.limit(0)).where("size(items) > 0").count() == 0


def typed_column(kind):
    return F.date_add(F.lit("2020-01-01").cast("date"), F.col("item_id").cast("int")) if kind == "date" else F.col("item_id").cast(kind)


def test_many_blocks_are_one_pass(spark):
    table = spark.createDataFrame([(i, f"words of item {i} that fill some bytes of a block") for i in range(40)], "item_id long, text string")
    plan = matches(docs(spark), table, block_bytes=800)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan
