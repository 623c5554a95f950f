"""The given tables in the shape of a lake, so that every operator runs on them; and the same shape as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EPOCH = "1995-01-01"


class Lake:
    """Lazy frames over ``sf_dir``; each reads only the columns that are used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @staticmethod
    def _height():
        return F.datediff(F.to_date("o_orderdate"), F.lit(EPOCH).cast("date")).cast("long")

    def blocks(self) -> DataFrame:
        day = self.table("orders").select(self._height().alias("number"), F.to_date("o_orderdate").alias("day")).distinct()
        return day.withColumn("chunk", F.floor(F.col("number") / 100).cast("long"))

    def transactions(self) -> DataFrame:
        return self.table("orders").select(self._height().alias("block_number"), F.col("o_orderkey").alias("transaction_index"), F.col("o_custkey").alias("from"), F.col("o_orderpriority").alias("type"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("nonce"), F.col("o_totalprice").alias("value"))

    def logs(self) -> DataFrame:
        li = self.table("lineitem")
        order = Window.partitionBy("l_orderkey").orderBy(*li.columns)
        rows = li.withColumn("log_index", (F.row_number().over(order) - 1).cast("long"))
        tx = self.table("orders").select("o_orderkey", self._height().alias("block_number"))
        return rows.join(tx, rows["l_orderkey"] == tx["o_orderkey"]).select("block_number", F.col("l_orderkey").alias("transaction_index"), "log_index", F.col("l_suppkey").alias("address"), F.col("l_returnflag").alias("topic0"), F.col("l_linestatus").alias("topic1"), F.lit(None).cast("string").alias("topic2"), F.lit(None).cast("string").alias("topic3"), F.col("l_quantity").cast("long").alias("data_size"))

    def calls(self) -> DataFrame:
        """A tree a region: the region, its nations, their customers."""
        r, n, c = self.table("region"), self.table("nation"), self.table("customer")
        row = lambda df, group, address, name: df.select(F.lit(0).cast("long").alias("block_number"), F.col(group).cast("long").alias("extrinsic_index"), address.cast("array<int>").alias("address"), name.alias("name"))
        return row(r, "r_regionkey", F.array(), F.lit("region")).unionByName(row(n, "n_regionkey", F.array("n_nationkey"), F.lit("nation"))).unionByName(
            row(c.join(n, c["c_nationkey"] == n["n_nationkey"]), "n_regionkey", F.array("n_nationkey", "c_custkey"), F.col("c_mktsegment"))
        )

    def call_events(self) -> DataFrame:
        """Orders as events of their customer's call; those of status P have no call."""
        o, c, n = self.table("orders"), self.table("customer"), self.table("nation")
        met = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
        address = F.when(F.col("o_orderstatus") != "P", F.array("n_nationkey", "c_custkey")).cast("array<int>")
        return met.select(F.lit(0).cast("long").alias("block_number"), F.col("n_regionkey").cast("long").alias("extrinsic_index"), F.col("o_orderkey").alias("index"), address.alias("call_address"), F.col("o_orderpriority").alias("name"))

    def catalog(self) -> DataFrame:
        """Chunks of a hundred heights, their ranges by what is in them; the tops change every five chunks."""
        b = self.blocks().groupBy("chunk").agg(F.min("number").alias("first_block"), F.max("number").alias("last_block"))
        return b.select(F.lit("orders").alias("dataset"), (F.floor(F.col("chunk") / 5) * 500).cast("long").alias("top"), "first_block", "last_block", "chunk")

    def ranges(self, offset: int, step: int, length: int) -> DataFrame:
        """Ranges that overlap, touch and leave gaps, one of every customer, a dataset a segment."""
        beg = F.col("c_custkey") * 11 + offset
        return self.table("customer").select(F.col("c_mktsegment").alias("dataset"), beg.cast("long").alias("beg"), (beg + F.col("c_nationkey") * step % length).cast("long").alias("end"))


#: The same lake for the SQL side, as common table expressions.
SQL = {
    "blocks": "SELECT DISTINCT datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS number, CAST(o_orderdate AS DATE) AS day, datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 100 AS chunk FROM orders",
    "txs": "SELECT datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS block_number, o_orderkey AS transaction_index, o_custkey AS \"from\", o_orderpriority AS type, o_orderstatus AS status, o_custkey AS nonce, o_totalprice AS value FROM orders",
    "logs": "SELECT datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS block_number, l_orderkey AS transaction_index, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS log_index, l_suppkey AS address, l_returnflag AS topic0, l_linestatus AS topic1, CAST(l_quantity AS BIGINT) AS data_size FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "calls": "SELECT 0 AS block_number, r_regionkey AS extrinsic_index, CAST([] AS INT[]) AS address, 'region' AS name FROM region UNION ALL SELECT 0, n_regionkey, [n_nationkey]::INT[], 'nation' FROM nation UNION ALL SELECT 0, n_regionkey, [n_nationkey, c_custkey]::INT[], c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "call_events": "SELECT 0 AS block_number, n_regionkey AS extrinsic_index, o_orderkey AS \"index\", CASE WHEN o_orderstatus <> 'P' THEN [n_nationkey, c_custkey]::INT[] END AS call_address, o_orderpriority AS name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    "catalog": "SELECT 'orders' AS dataset, (chunk // 5) * 500 AS top, min(number) AS first_block, max(number) AS last_block, chunk FROM blocks GROUP BY chunk",
    "ra": "SELECT c_mktsegment AS dataset, c_custkey * 11 AS beg, c_custkey * 11 + c_nationkey * 3 % 50 AS \"end\" FROM customer",
    "rb": "SELECT c_mktsegment AS dataset, c_custkey * 11 + 7 AS beg, c_custkey * 11 + 7 + c_nationkey * 7 % 40 AS \"end\" FROM customer",
    # samples of the events of a type that lie over an hour apart (the second one at any time after the first), and how many events each saw
    "seen": "SELECT event_type, epoch_us(CAST(ts AS TIMESTAMP)) / 1000000 AS sec FROM events",
    "sample": "SELECT event_type, min(sec) AS sec, CAST(1 AS BIGINT) AS k FROM seen GROUP BY 1 UNION ALL SELECT s.event_type, min(e.sec), s.k + 1 FROM sample s JOIN seen e ON e.event_type = s.event_type AND e.sec > s.sec + CASE WHEN s.k = 1 THEN 0 ELSE 3600 END GROUP BY s.event_type, s.k",
    "heights": "SELECT event_type, k, sec, (SELECT count(*) FROM seen e WHERE e.event_type = s.event_type AND (s.next IS NULL OR e.sec < s.next)) AS number FROM (SELECT *, lead(sec) OVER (PARTITION BY event_type ORDER BY k) AS next FROM sample) s",
    "last": "SELECT * FROM heights QUALIFY k = max(k) OVER (PARTITION BY event_type)",
}
NEEDS = {"catalog": ("blocks",), "last": ("seen", "sample", "heights")}


def with_lake(sql: str, *names: str) -> str:
    """``sql`` after the expressions it names."""
    every = list(dict.fromkeys(x for n in names for x in (*NEEDS.get(n, ()), n)))
    return ("WITH RECURSIVE " if every else "") + ", ".join(f"{n} AS ({SQL[n]})" for n in every) + " " + sql
