"""Small tables with the hard cases: nulls, empty and long texts, ties, repeated rows, copies, clashing column names."""

from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    r = random.Random(seed)
    return [f"{r.choice(['Wo', 'la', 'ké', 'ß', 'mi'])}{r.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed: int = 1) -> list[tuple]:
    """Rows with exact and near copies, shared passages, repeats inside a text, and degenerate texts."""
    r = random.Random(seed)
    base, passage = prose(seed, 160), prose(seed + 1, 60)
    texts: list[str | None] = [None, "", "  \n\t ", "one", "two words", "three more words", "a b c d", "a b c d", "x y " * 200, "Ha. " * 90, "\n".join(["Same line here."] * 30)]
    for k in range(12):  # near copies of one base, some with few edits and some with many
        words = list(base)
        for _ in range(k):
            words[r.randrange(len(words))] = f"edit{k}x{r.randrange(1000)}"
        texts.append(" ".join(words))
    texts += [" ".join(base)] * 3
    for k in range(6):
        texts.append(" ".join(prose(seed + 10 + k, r.randrange(20, 90)) + passage + prose(seed + 30 + k, r.randrange(0, 50))))
    texts += [" ".join(prose(seed + 50 + k, r.randrange(1, 120))) for k in range(12)]
    texts.append("\n".join(" ".join(prose(seed + 70, 3000)[i : i + 12]) for i in range(0, 3000, 12)))
    rows = [(i, t, ["en", "fr", None][i % 3], [None, "s1", "s2", "s0"][i % 4], None) for i, t in enumerate(texts)]
    return [*rows, rows[20], (None, "nobody's text of some words", None, None, None), (7, "another text with an id that is there already", "en", "s1", 3)]


def docs(spark, rows=None):
    """As a table with a column whose name clashes with one an operator uses inside."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(corpus() if rows is None else rows, DOCS).withColumn("th", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("spans", F.lit(None).cast("string"))


def spaced(text: str | None) -> list[str]:
    return SPACED.findall(text or "")
