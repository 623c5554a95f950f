"""What the training-data operators share: row identity, tables in the shared folder, Arrow text buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.sources.shared import shared_dir

#: White space that separates words, as a regular expression class; words are maximal runs of anything else.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts its lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` uses it (also inside lambdas)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def space_count_words(text: Column) -> Column:
    """Number of words of a text; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def spare(columns: list[str], *names: str) -> list[str]:
    """Names for columns of our own that none of ``columns`` has, whatever their case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, th, text``: a row is known by its id and a hash of its text, so ids that repeat with other texts stay apart.

    Rows alike in both count as two occurrences of one text and get the same result. A null text is an empty one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("th"), body.alias("text"))


def identified(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, id, th, text`` as of :func:`keyed`: ``id`` is a hash of ``doc_id``, which may be null and of any type that sorts.

    Tables on the way are joined by ``id, th``. Two rows that have both in common have one text, and so the same result.
    """
    return keyed(docs, text).select("doc_id", F.xxhash64("doc_id").alias("id"), "th", "text")


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (first is 0) of a string column without nulls, with no copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each: whole texts, never a part, so that scratch arrays stay small."""
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end
        row = end
