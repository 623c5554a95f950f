import math
import os
import random
import string

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blocklake.llm import toxicity as T
from blocklake.llm.common import text_buffers
from tests.llm.fixtures import docs, prose


def labelled(n, seed=0):
    """Toxic texts have three or more words of a bad stem; others have one at most."""
    r = random.Random(seed)
    for i in range(n):
        words = prose(seed * 1000 + i, r.randrange(5, 120), 3000)
        toxic = i % 4 == 0
        for _ in range(r.randrange(3, 6) if toxic else r.randrange(0, 2)):
            words.insert(r.randrange(len(words)), f"sluuur{r.choice('abcdefgh')}{r.randrange(50)}")
        yield i, " ".join(words), int(toxic)


def test_held_out_accuracy(spark):
    rows = list(labelled(900))
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = T.train(table, labels, max_rows=400)
    got = T.score(table, model).withColumn("held", T.held_out(F.col("doc_id"))).collect()
    y = {i: v for i, _, v in rows}
    held = [(r.score, y[r.doc_id]) for r in got if r.held]
    assert len(held) > 200 and all(0 <= s <= 1 for s, _ in held)
    bad, good = (np.array([s for s, v in held if v == k]) for k in (1, 0))
    assert (bad[:, None] > good[None, :]).mean() > 0.95
    assert np.mean(bad >= 0.7) > 0.6 and np.mean(good >= 0.7) < 0.05


def test_scores_do_not_depend_on_neighbours_or_slices():
    model = T.fit(pa.array([t for _, t, _ in labelled(60)]), np.array([y for *_, y in labelled(60)], float), np.ones(60), ["en"] * 60, epochs=2)
    texts = ["", "word", "a b", "Sluuura1 SLUUURA1 x", "é" * 50, " ".join(prose(4, 5000)), *[t for _, t, _ in labelled(20, 9)]]
    together = model.scores(*text_buffers(pa.array(texts)))
    alone = [model.scores(*text_buffers(pa.array([t])))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


def test_nulls_clashing_columns_and_language_thresholds(spark):
    model = T.fit(pa.array(["bad bad words", "good text"] * 15), np.array([1.0, 0.0] * 15), np.ones(30), [None] * 30, epochs=2)
    model.thresholds = {"en": 0.0, "fr": 1.1}
    table = docs(spark).withColumn("score", F.lit("clash")).withColumn("toxic", F.lit("clash"))
    got = T.score(table, model).collect()
    assert len(got) == docs(spark).count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.toxic for r in got if r.lang == "en") and not any(r.toxic for r in got if r.lang == "fr")
    assert T.score(docs(spark, []), model).count() == 0


def test_fit_without_rows_or_with_one_class(spark):
    none = T.fit(pa.array([], pa.string()), np.zeros(0), np.zeros(0), [])
    assert none.scores(*text_buffers(pa.array(["any text"])))[0] == 0.5
    one = T.fit(pa.array(["a", "b"]), np.zeros(2), np.ones(2), ["en", "en"])
    assert one.scores(*text_buffers(pa.array(["any text"])))[0] < 0.1
    assert T.train(docs(spark), spark.createDataFrame([], "doc_id long, toxic int")).shift == 0.0


def naive_logit(model, text):
    """One word, one filter, one place after the other, without numpy's tricks."""
    words = [w for w in "".join(c.lower() if c in string.ascii_letters else c if c in string.digits or ord(c) > 127 else " " for c in text).split()]
    vectors = []
    for w in words:
        ids, _ = T.features(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))
        vectors.append([sum(float(model.embeddings[i][d]) for i in ids[0]) for d in range(T.DIM)])
    vectors += [[0.0] * T.DIM] * T.PAD  # a text ends in words that say nothing
    pooled, k = [], 0
    for w, width in enumerate(T.WIDTHS):
        best = []
        for f in range(T.FILTERS):
            values = set()
            for at in range(len(vectors) - width + 1):
                values.add(round(sum(vectors[at + o][d] * float(model.filters[d][(k + o) * T.FILTERS + f]) for o in range(width) for d in range(T.DIM)), 5))
            best.append(sorted(values, reverse=True)[: T.TOP])
        for t in range(T.TOP):
            pooled += [max(best[f][t] + float(model.bias[w][f]), 0.0) if t < len(best[f]) else 0.0 for f in range(T.FILTERS)]
        k += width
    return sum(p * float(t) for p, t in zip([*pooled, math.log1p(len(words)) / 8], model.top, strict=True)) + model.shift


def test_the_forward_pass_against_a_naive_one():
    model = T.fit(pa.array([t for _, t, _ in labelled(80)]), np.array([y for *_, y in labelled(80)], float), np.ones(80), ["en"] * 80, epochs=3)
    for text in ["", "one", "two words", "Sluuura1, sluuurb2! né ß9 x", "a b a b a b a b", *[t for _, t, _ in labelled(12, 5)]]:
        got = model.logits(*T.features(*text_buffers(pa.array([text]))))[0]
        assert abs(got - naive_logit(model, text)) < 1e-3, text


def test_the_gradient_against_differences():
    """A step of plain descent along what training changes lowers the loss; every kind of parameter takes part."""
    texts, y = pa.array([t for _, t, _ in labelled(120)]), np.array([v for *_, v in labelled(120)], float)
    before, after = (T.fit(texts, y, np.ones(120), ["en"] * 120, epochs=e) for e in (0, 4))
    loss = lambda m: np.mean(np.logaddexp(0, np.where(y > 0, -1, 1) * m.logits(*T.features(*text_buffers(texts)))))
    assert loss(after) < loss(before)
    assert all(np.abs(getattr(after, n) - getattr(before, n)).max() > 1e-4 for n in ("embeddings", "filters", "bias", "top"))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the given tables")
def test_a_thousand_documents_suffice_for_the_common_words(spark):
    """286 labelled rows to learn from, 33 of them toxic: most held-out toxic rows are found, with few false alarms."""
    got = {r.doc_id: r for r in T.query(spark, "/root/testdata/sf0.01").where("held_out").collect()}
    y = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(r.score, r.predicted, y[i]) for i, r in got.items() if i in y and y[i] is not None]
    bad, good = (np.array([s for s, _, v in held if v == k]) for k in (1, 0))
    assert (bad[:, None] > good[None, :]).mean() > 0.9
    assert np.mean(bad >= 0.7) > 0.5 and np.mean(good >= 0.7) < 0.03
