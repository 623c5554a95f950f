"""A corpus from raw documents: five stages, each a table written as Parquet and read again as the next one's input.

toxicity, n-gram Jaccard join, benchmark decontamination, mixing to target weights, sharding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.llm import decontaminate, jaccard, mixing, sharding, toxicity
from blocklake.llm.common import WORD, spare, stored, table

#: No SQL for a trained classifier; tests hold each stage against a brute-force version.
ORACLE_SQL = None
#: The contract of near duplicates where no other is stated: runs of five words, a similarity of 0.8 or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _row(docs: DataFrame) -> Column:
    """A hash of the whole row (but for maps, which have none): rows that share it are one row."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled rows that are not held out, does not reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score, toxic = spare(docs.columns, "score", "toxic")
    return toxicity.score(docs, model, names=(score, toxic)).where(~F.col(toxic)).select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row of the least id (null last), then of the least text hash; texts without words all stay.

    Of rows that are alike in both, the one of the least hash over all columns stays.
    """
    found = jaccard.jaccard_components(docs, n_words=NEAR_WORDS, percent=NEAR_PERCENT)
    # groups are told apart by their component: ids may be null or repeat
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("th").alias("th")))
    kept = found.where(F.col("component").isNotNull()).groupBy("component").agg(first.alias("k"))
    own_id, th, row = spare(docs.columns, "id", "th", "row")
    chosen = kept.select(F.xxhash64("k.doc_id").alias(own_id), F.col("k.th").alias(th))
    worded = F.coalesce("text", F.lit("")).rlike(WORD)
    keyed = docs.where(worded).withColumns({own_id: F.xxhash64("doc_id"), th: F.xxhash64("text")}).join(chosen, [own_id, th], "left_semi")
    one = keyed.groupBy(own_id, th).agg(F.min_by(F.struct(*_columns(docs)), _row(docs)).alias(row)).select(f"{row}.*")
    return one.unionByName(docs.where(~worded))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with no window of ten words of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*_columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, in the order of the mix: shard after shard, each shuffled."""
    row, shard, position = spare(docs.columns, "row", "shard", "position")
    keyed = docs.withColumn(row, _row(docs))
    draws, _ = mixing.mix(keyed.select(F.col(row).alias("doc_id"), "source", "text"))
    drawn = draws.select(F.col("doc_id").alias(row), F.col("shard").alias(shard), F.col("position").alias(position))
    mixed = keyed.dropDuplicates([row]).join(drawn, row)  # rows alike in all columns share what was drawn for them
    return mixed.repartition(shard).sortWithinPartitions(shard, position).select(*_columns(docs))


def shard_corpus(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard, known by the least id in it, in the committed version."""
    shard, version, shard_id, shard_docs = spare(docs.columns, "shard", "version", "shard_id", "shard_docs")
    sharded = sharding.shard(docs, names=(shard, version))
    return sharding.with_totals(sharded, shard, {shard_id: F.min("doc_id"), shard_docs: F.count("*")}).select(*_columns(docs), shard_id, shard_docs, version)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard_corpus),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
