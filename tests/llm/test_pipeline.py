from collections import Counter

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.fixtures import DOCS, corpus  # noqa: E402


@pytest.fixture()
def sf_dir(spark, tmp_path):
    rows = [(i, t, "en", s, 0) for i, (_, t, _, s, _) in enumerate(corpus())]
    rows += [(1000 + i, f"text {i} of {' '.join(f'w{i}x{k}' for k in range(40))} trash idiot scum", "en", "s1", 0) for i in range(30)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], 1, int(r[0] >= 1000)) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    leaked = next(r[1] for r in rows if r[1] and len(r[1].split()) > 1000)
    spark.createDataFrame([(1, " ".join(leaked.split()[50:80]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_each_stage_keeps_what_it_should(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "sharding"]
    out = stages["toxicity"](spark, docs, sf_dir)
    kept = {r.doc_id for r in out.collect()}
    assert out.columns == docs.columns and kept <= {r.doc_id for r in docs.collect()} and len([i for i in kept if i < 1000]) >= 40
    out = stages["ngram_jaccard_join"](spark, docs, sf_dir)
    from tests.llm.test_jaccard import brute

    rows = [tuple(r) for r in docs.collect()]
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, _, c in brute(rows, 5, 80)}) and out.columns == docs.columns
    out = stages["benchmark_decontamination"](spark, docs, sf_dir)
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in out.collect()}
    assert gone and all(len(r.text.split()) > 1000 for r in docs.collect() if r.doc_id in gone)
    out = stages["mixing"](spark, docs, sf_dir)
    assert out.columns == docs.columns and max(Counter(r.doc_id for r in out.collect()).values()) <= 3
    out = stages["sharding"](spark, docs, sf_dir)
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in docs.collect())


def test_run_is_its_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert out and {r.version for r in out} and all(r.text for r in out)


def test_near_duplicates_with_null_and_repeated_ids(spark):
    from tests.llm.fixtures import prose
    from tests.llm.test_jaccard import brute

    text = lambda k: " ".join(prose(500 + k, 60, 4000))
    rows = [(None if i % 3 == 0 else i // 2, text(i), "en", "s", i) for i in range(24)]  # nobody's, and two texts to an id
    rows += [(None, text(0) + " end", "en", "s", 90), (None, text(1), "en", "s", 91), (50, text(3), "en", "s", 92), (51, text(3) + " end", "en", "s", 93)]
    rows += [(None, text(30), "en", "s", 95), (None, text(30), "en", "s", 95), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (None, None, "en", "s", 0), (None, " \n", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    hashes = [r.h for r in docs.selectExpr("xxhash64(coalesce(text, '')) AS h").collect()]
    groups, want = [], [r for r in rows if not (r[1] or "").split()]
    for r, h in sorted(zip(rows, hashes, strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[1])):
        if r not in want and not any(len({k[2] for k in brute([(0, r[1]), (1, other)], 5, 80)}) == 1 for other in groups):
            want.append(r)
            groups.append(r[1])
        elif r not in want:
            groups.append(r[1])
    assert len(want) == 24 + 1 + 4
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in want)


CLASHING = ("id", "th", "row", "shard", "version", "position", "score", "toxic", "_id", "_th", "_copy", "shard_id", "key", "run", "doc_id_", "sid", "component")


def test_stages_keep_columns_whose_names_clash_and_rows_alike(spark, sf_dir):
    """Null and repeated ids, rows alike in id, text and source but for another column, and our own names as columns."""
    rows = [*corpus(), *[(5, "one text of some words", "en", "s1", k) for k in (1, 2, 2)], *[(None, "nobody's second text is here", "fr", None, k) for k in (1, 1, 4)]]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.concat(F.lit(f"{c}:"), F.col("n_chars").cast("string")) for c in CLASHING})
    extra = lambda r: tuple(r[c] for c in CLASHING)
    before = {(r.doc_id, r.text, r.source, r.n_chars, extra(r)) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        got = [(r.doc_id, r.text, r.source, r.n_chars, extra(r)) for r in out.collect()]
        assert got and set(got) <= before, name
        if name == "mixing":
            assert out.columns == docs.columns
            sizes = Counter()
            for r in rows:
                sizes[r[3]] += len((r[1] or "").split())
            assert len([g for g in got if g[0] == 5 and g[3] == 1]) <= 3 and sum(len(g[1].split()) for g in got) <= sum(sizes.values()) * 1.05
        elif name == "sharding":
            assert Counter(got) == Counter((r.doc_id, r.text, r.source, r.n_chars, extra(r)) for r in docs.collect()) and len(out.columns) == len(docs.columns) + 3
        else:
            assert out.columns == docs.columns


def test_stages_of_empty_tables(spark, sf_dir):
    empty = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name


def test_the_mix_is_written_in_its_order(spark, sf_dir):
    rows = [(i, "w " * 50, "en", f"s{i % 3}", 0) for i in range(400)]
    out = corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, DOCS), sf_dir)
    ids = [r.doc_id for part in out.rdd.glom().collect() for r in part]
    assert ids != sorted(ids) and sum(a == b for a, b in zip(ids, ids[1:], strict=False)) < len(ids) / 10
