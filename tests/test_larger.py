"""Queries on tables that are larger, or have larger keys, than the given ones."""

from __future__ import annotations

import datetime

from blocklake.plans import registry
from blocklake.sources.adapter import Lake


def orders(spark, path, keys):
    """A lake of orders of one day, each with two line items."""
    day = datetime.datetime(1995, 3, 1)
    spark.createDataFrame([(k, k % 7 + 1, "O", 1.0, day, "1-URGENT") for k in keys], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").coalesce(1).write.parquet(f"{path}/orders.parquet")
    lines = [(k, 1, 5, i, 2.0, 1.0, 0.0, 0.0, "N", "O", day) for k in keys for i in range(2)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_raw_lines_do_not_grow_with_the_orders_of_a_day(spark, tmp_path):
    keys = list(range(0, 200_000, 500))
    path = orders(spark, tmp_path, keys)
    sizes = [len(r.transactions) for r in registry._raw_orders(Lake(spark, path)).select("transactions").collect()]
    assert sum(sizes) == len(keys) and max(sizes) <= 40
    got = registry.QUERIES["ingest_transactions"](spark, path).collect()
    assert sorted(r.transaction_index for r in got) == keys and {r.block_number for r in got} == {59}
    assert sorted((r.transaction_index, r.log_index) for r in registry.QUERIES["ingest_logs"](spark, path).collect()) == [(k, i) for k in keys for i in range(2)]


def test_safe_integer_beyond_63_bits(spark, tmp_path):
    got = registry.QUERIES["safe_integer"](spark, orders(spark, tmp_path, [1, 1000, 2_000_000])).orderBy("id").collect()
    assert [r.j for r in got] == ['{"v":9007199254740}', '{"v":9007199254740000}', '{"v":"18014398509480000000"}']


def test_quantities_beyond_63_bits(spark, tmp_path):
    small = registry.QUERIES["convert_quantities"](spark, orders(spark, tmp_path / "small", [0, 3, (1 << 23) - 1]))
    assert dict(small.dtypes)["v"] == "bigint" and sorted(r.v for r in small.collect()) == [0, 3 << 40, ((1 << 23) - 1) << 40]
    large = registry.QUERIES["convert_quantities"](spark, orders(spark, tmp_path / "large", [0, 3, 1 << 23, 54_000_000])).orderBy("id").collect()
    assert [(int(r.v), int(r.d)) for r in large] == [(k << 40, k << 60) for k in (0, 3, 1 << 23, 54_000_000)]
