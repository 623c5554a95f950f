"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from blocklake.plans import registry

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the given tables")


def shown(df: pd.DataFrame) -> list[list[str]]:
    def one(v) -> str:
        if v is None or (not isinstance(v, (str, list)) and pd.isna(v)):
            return "null"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    return sorted([one(v) for v in row] for row in df[sorted(df.columns)].to_numpy(dtype=object).tolist())


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for p in SF.iterdir():
        db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return db


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    got, want = registry.QUERIES[name](spark, str(SF)).toPandas(), con.execute(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert shown(got) == shown(want)
