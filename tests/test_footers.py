"""Footers of a lake: columns by chunk, skipping by value, metadata without rows."""

from __future__ import annotations

import pytest

from blocklake.sources import footers, layout

KIND = "block_number long, v int, x double, s string, n struct<a:int>"


def lake(spark, root, chunks: int, without: tuple = (), files: int = 1):
    """Ten heights a chunk; ``v`` is ten times the height, ``x`` a tenth, ``s`` its text, null in the first chunk."""
    for k in range(chunks):
        rows = [(n, n * 10, n / 10, None if k == 0 else f"{n:04d}", (n,)) for n in range(k * 10, k * 10 + 10)]
        df = spark.createDataFrame(rows, KIND).repartition(files)
        df.drop(*(without if k == chunks - 1 else ())).write.parquet(f"{root}/0000000000/{k * 10:010d}-{k * 10 + 9:010d}-abc/logs.parquet")
    return str(root)


def first_of(df) -> list[int]:
    return sorted(int(r.path[-25:-15]) for r in df.collect())


def test_ends_and_nulls(spark, tmp_path):
    root = lake(spark, tmp_path, 3, files=2)
    found = footers.footers(spark, root, "logs")
    assert found.select("file").distinct().count() == 6
    told = {(int(r.path[-25:-15]), r.column): r for r in footers.columns_of_chunks(found).collect()}
    assert len(told) == 15
    v, x, s, n = (told[20, c] for c in ("v", "x", "s", "n"))
    assert (v.type, v.rows, v.nulls, v.low_long, v.high_long, v.low_text) == ("int", 10, 0, 200, 290, None)
    assert (x.type, x.low_double, x.high_double) == ("double", 2.0, 2.9) and (s.low_text, s.high_text) == ("0020", "0029")
    assert (n.type, n.nulls, n.low_long) == ("struct<a:int>", None, None)
    assert (told[0, "s"].nulls, told[0, "s"].low_text) == (10, None)
    assert first_of(footers.footers(spark, root, "logs", 12, 15).select("path").distinct()) == [10]
    assert footers.footers(spark, str(tmp_path / "none"), "logs").count() == 0 and footers.footers(spark, root, "traces").count() == 0


def test_chunks_that_may_hold_values(spark, tmp_path):
    found = footers.footers(spark, lake(spark, tmp_path, 4, without=("v",)), "logs")
    hold = lambda *a: first_of(footers.may_hold(found, *a))
    assert hold("v", 150, 150) == [10, 30] and hold("v", None, 90) == [0, 30] and hold("v", 195, 199) == [30]  # the last chunk says nothing of v
    assert hold("block_number", 10, 19) == [10] and hold("block_number", 5, None) == [0, 10, 20, 30]
    assert hold("x", 1.95, 1.99) == [] and hold("x", 2, 2) == [20] and hold("block_number", 9.5, 10.5) == [10]
    assert hold("s", "0015", "0021") == [10, 20] and hold("s", "z", None) == []  # only nulls in the first chunk
    assert hold("n", 1, 1) == [0, 10, 20, 30]


def test_metadata_without_rows(spark, tmp_path):
    root = lake(spark, tmp_path, 2, without=("x",))
    got = {r.column: (r.type, r.nullable, r.nulls) for r in footers.metadata({"logs": footers.footers(spark, root, "logs")}).collect()}
    assert got == {"block_number": ("bigint", False, 0), "v": ("int", False, 0), "x": ("double", True, 10), "s": ("string", True, 10), "n": ("struct<a:int>", None, None)}


def test_a_column_that_the_last_of_many_chunks_lacks(spark, tmp_path):
    root = lake(spark, tmp_path, 30, without=("s",))
    with pytest.raises(layout.MissingData, match="no column s in .*0000000290-0000000299"):
        layout.read_table(spark, root, "logs", columns=["v", "s"])
    assert layout.read_table(spark, root, "logs", 0, 289, columns=["v", "s"]).count() == 290


def test_reads_skip_chunks(spark, tmp_path):
    root = lake(spark, tmp_path, 5)
    stored = footers.footers(spark, root, "logs").cache()
    got = layout.read_table(spark, root, "logs", columns=["block_number"], within={"v": (185, 220)}, footers=stored)
    assert sorted(r.block_number for r in got.collect()) == [19, 20, 21, 22]
    assert len({f.split("/")[-2] for f in got.inputFiles()}) == 1 and len({f.split("/")[-3] for f in got.inputFiles()}) == 2
    none = layout.read_table(spark, root, "logs", columns=["block_number"], within={"v": (1000, 2000)}, footers=stored)
    assert none.columns == ["block_number"] and none.count() == 0
    either = layout.read_table(spark, root, "logs", 12, 38, within={"x": (None, 2.0), "s": ("0013", None)}, footers=stored)
    assert sorted(r.block_number for r in either.collect()) == list(range(13, 21))
