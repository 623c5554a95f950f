"""Queries over whole given tables, one for each operator, by name, and DuckDB SQL for the same results."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blocklake.functions import project as P
from blocklake.operators import assemble as A
from blocklake.operators import audit, predicates, ranges
from blocklake.operators import budget as B
from blocklake.operators import ingest as I
from blocklake.operators import relations as R
from blocklake.plans import query as build
from blocklake.plans.chains.evm import MODEL as EVM
from blocklake.plans.chains.raw import RAW
from blocklake.plans.specs import TableSpec
from blocklake.plans.tables import ingest as tables_of_chain
from blocklake.plans.tables import raw_schema, rule_of
from blocklake.sources import footers, layout, sinks
from blocklake.sources.adapter import Lake, with_lake
from blocklake.sources.shared import shared_dir
from blocklake.streaming import stream as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TX, LOG, GROUP = ["transaction_index"], ["transaction_index", "log_index"], [("extrinsic_index", "extrinsic_index")]
ADDRESS = ("address", "address")


def query(sql: str | None = None, *needs: str):
    """Registers ``f(lake)`` under its name, with SQL over the lake's expressions."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Lake(spark, sf_dir))
        if sql:
            SQL[f.__name__] = with_lake(sql, *needs)
        return f

    return register


def keys(df: DataFrame, *more: str) -> DataFrame:
    return df.select("block_number", *more)


def text(c: str):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ".")


# scans and predicates


@query("SELECT block_number, transaction_index, log_index FROM logs WHERE address = 7", "logs")
def scan_in_one(lake):
    return predicates.scan(lake.logs(), [predicates.field_in("address", [7])], LOG)


@query("SELECT block_number, transaction_index, log_index FROM logs WHERE address IN (3, 5, 8, 13) AND topic0 IN ('A', 'R')", "logs")
def scan_in_many(lake):
    both = predicates.all_of([predicates.field_in("address", [3, 5, 8, 13]), predicates.field_in("topic0", ["A", "R"])])
    return predicates.scan(lake.logs(), [both], LOG)


@query("SELECT block_number, transaction_index, log_index FROM logs WHERE topic0 = 'R'", "logs")
def scan_in_empty(lake):
    """An empty list matches nothing, but the request beside it does."""
    return predicates.scan(lake.logs(), [predicates.field_in("address", []), predicates.field_in("topic0", ["R"])], LOG)


@query("SELECT block_number, transaction_index FROM txs WHERE nonce BETWEEN 100 AND 400 AND block_number BETWEEN 50 AND 1500", "txs")
def scan_range_gte_lte(lake):
    bounds = predicates.all_of([predicates.field_gte("nonce", 100), predicates.field_lte("nonce", 400)])
    return predicates.scan(lake.transactions(), [bounds], TX, limits=predicates.block_range(50, 1500))


@query("SELECT block_number, transaction_index FROM txs WHERE status = 'F'", "txs")
def scan_eq_bool(lake):
    return predicates.scan(lake.transactions().withColumn("final", F.col("status") == "F"), [predicates.field_eq("final", True)], TX)


@query("SELECT block_number, transaction_index, log_index FROM logs WHERE address = 4 OR (topic0 = 'N' AND topic1 = 'F') OR (address = 9 AND topic0 = 'R')", "logs")
def scan_or_requests(lake):
    one, all_of = predicates.field_in, predicates.all_of
    return predicates.scan(lake.logs(), [one("address", [4]), all_of([one("topic0", ["N"]), one("topic1", ["F"])]), all_of([one("address", [9]), one("topic0", ["R"])])], LOG)


@query("SELECT block_number, transaction_index, \"from\" FROM txs", "txs")
def scan_key_projection(lake):
    return predicates.scan(lake.transactions(), [None], TX, ("from",))


@query("SELECT block_number, transaction_index FROM txs WHERE nonce % 3 = 0 AND nonce < 6000", "txs")
def scan_long_list(lake):
    return predicates.where_in(lake.transactions(), "nonce", list(range(0, 6000, 3))).select("block_number", "transaction_index")


# relations


def some_logs(lake):
    return predicates.scan(lake.logs(), [predicates.field_in("address", [7])], LOG)


def some_txs(lake):
    return predicates.scan(lake.transactions(), [predicates.field_in("type", ["1-URGENT"])], TX)


def some_calls(lake, *names):
    return predicates.scan(lake.calls(), [predicates.field_in("name", list(names))], ["extrinsic_index", "address"])


@query("SELECT block_number, transaction_index, type FROM txs t WHERE EXISTS (SELECT 1 FROM logs l WHERE l.address = 7 AND l.block_number = t.block_number AND l.transaction_index = t.transaction_index)", "txs", "logs")
def ref_parent(lake):
    return R.select_items(lake.transactions(), [R.ref_parent(some_logs(lake), TX, TX)], TX).select("block_number", "transaction_index", "type")


@query("SELECT block_number, transaction_index, log_index FROM logs l WHERE EXISTS (SELECT 1 FROM txs t WHERE t.type = '1-URGENT' AND l.block_number = t.block_number AND l.transaction_index = t.transaction_index)", "txs", "logs")
def join_children(lake):
    return keys(R.join_children(lake.logs(), some_txs(lake), [(TX[0], TX[0])]), *LOG)


@query("SELECT block_number, transaction_index, log_index FROM logs l WHERE EXISTS (SELECT 1 FROM logs s WHERE s.address = 7 AND l.block_number = s.block_number AND l.transaction_index = s.transaction_index)", "logs")
def join_same_parent(lake):
    return keys(R.join_same_parent(lake.logs(), some_logs(lake), [(TX[0], TX[0])]), *LOG)


_EVENTS = "SELECT \"index\" FROM call_events i WHERE EXISTS (SELECT 1 FROM calls s WHERE s.name = '{name}' AND i.extrinsic_index = s.extrinsic_index AND {test})"
_CALLS = "SELECT extrinsic_index, array_to_string(address, '.') AS address FROM calls i WHERE EXISTS (SELECT 1 FROM {scan} s WHERE s.name = '{name}' AND i.extrinsic_index = s.extrinsic_index AND {test})"


def shown(df):
    return df.select("extrinsic_index", text("address").alias("address"))


@query(_EVENTS.format(name="BUILDING", test="i.call_address = s.address"), "calls", "call_events")
def join_exact_address(lake):
    return R.join_at(lake.call_events(), some_calls(lake, "BUILDING"), GROUP, ("call_address", "address")).select("index")


@query(_CALLS.format(scan="calls", name="nation", test="len(i.address) > len(s.address) AND i.address[1:len(s.address)] = s.address"), "calls")
def descendants(lake):
    return shown(R.descendants(lake.calls(), some_calls(lake, "nation"), GROUP, ADDRESS))


@query(_EVENTS.format(name="nation", test="len(i.call_address) >= len(s.address) AND i.call_address[1:len(s.address)] = s.address"), "calls", "call_events")
def descendants_or_self(lake):
    return R.descendants(lake.call_events(), some_calls(lake, "nation"), GROUP, ("call_address", "address"), include_self=True).select("index")


@query(_CALLS.format(scan="calls", name="region", test="len(i.address) > 0"), "calls")
def subtree(lake):
    return shown(R.subtree(lake.calls(), some_calls(lake, "region"), GROUP, ADDRESS))


@query(_CALLS.format(scan="calls", name="MACHINERY", test="len(i.address) < len(s.address) AND s.address[1:len(i.address)] = i.address"), "calls")
def ancestors(lake):
    return shown(R.ancestors(lake.calls(), some_calls(lake, "MACHINERY"), GROUP, ADDRESS))


@query(_CALLS.format(scan="call_events", name="1-URGENT", test="len(i.address) <= len(s.call_address) AND s.call_address[1:len(i.address)] = i.address"), "calls", "call_events")
def ancestors_or_self(lake):
    events = predicates.scan(lake.call_events(), [predicates.field_in("name", ["1-URGENT"])], ["index"], ("extrinsic_index", "call_address"))
    return shown(R.ancestors(lake.calls(), events, GROUP, ("address", "call_address"), include_self=True))


@query(", up AS (SELECT extrinsic_index, address[1:len(address) - 1] AS address FROM calls WHERE name = 'FURNITURE' AND len(address) > 0 UNION SELECT extrinsic_index, address[1:len(address) - 1] FROM up WHERE len(address) > 0) SELECT DISTINCT c.extrinsic_index, array_to_string(c.address, '.') AS address FROM calls c JOIN up USING (extrinsic_index, address)", "calls")
def parents_recursive(lake):
    return shown(R.ancestors(lake.calls(), some_calls(lake, "FURNITURE"), GROUP, ADDRESS))


@query(_CALLS.format(scan="calls", name="nation", test="len(i.address) = len(s.address)"), "calls")
def siblings(lake):
    return shown(R.siblings(lake.calls(), some_calls(lake, "nation"), GROUP, ADDRESS))


@query("SELECT block_number, transaction_index, log_index, address FROM logs WHERE address IN (7, 11) OR topic0 = 'A' AND topic1 = 'F' AND address < 20", "logs")
def select_items_union(lake):
    a = predicates.scan(lake.logs(), [predicates.field_in("address", [7, 11])], LOG)
    b = predicates.scan(lake.logs(), [predicates.all_of([predicates.field_eq("topic0", "A"), predicates.field_eq("topic1", "F"), F.col("address") < 20])], LOG)
    return R.select_items(lake.logs(), [R.scan_keys(a, LOG), b], LOG).select("block_number", *LOG, "address")


@query("SELECT DISTINCT extrinsic_index, array_to_string(call_address, '.') AS address FROM call_events e WHERE call_address IS NOT NULL", "call_events")
def null_keys(lake):
    parents = R.ref_parent(lake.call_events(), ["extrinsic_index", "call_address"], ["extrinsic_index", "address"])
    return shown(R.select_items(lake.calls(), [parents], ["extrinsic_index", "address"]))


@query("SELECT block_number, transaction_index AS k FROM txs UNION ALL SELECT block_number, address FROM logs", "txs", "logs")
def union_all_keys(lake):
    return R.union_keys([lake.transactions().select("block_number", F.col("transaction_index").alias("k")), lake.logs().select("block_number", F.col("address").alias("k"))])


@query("SELECT DISTINCT block_number, address FROM logs", "logs")
def distinct_keys(lake):
    return A.distinct_keys(lake.logs().select("block_number", "address"))


@query("SELECT extrinsic_index, unnest(address) AS step FROM calls", "calls")
def unnest_addresses(lake):
    return A.unnest(lake.calls().select("extrinsic_index", F.col("address").alias("step")), "step")


@query("SELECT t.transaction_index, t.type, l.n, l.q FROM txs t LEFT JOIN (SELECT l_orderkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) l ON t.transaction_index = l.l_orderkey", "txs")
def attach_receipts(lake):
    receipts = lake.table("lineitem").where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("q"))
    return R.attach_receipts(lake.transactions(), receipts, "transaction_index", "l_orderkey").select("transaction_index", "type", "n", "q")


@query("SELECT e.event_id AS hash FROM events e ANTI JOIN orders ON event_id = o_orderkey * 2")
def replay_assignment(lake):
    tx = lake.table("orders").select((F.col("o_orderkey") * 2).alias("hash"))
    return R.assign_replays(tx, lake.table("events").select(F.col("event_id").alias("hash")))[1]


# weights, budgets, blocks

_WEIGHT = "SELECT doc_id, CAST(coalesce(strlen(text), 0) + 512 + 32 AS BIGINT) AS weight FROM documents"


@query(_WEIGHT)
def row_weight(lake):
    df = lake.table("documents").withColumn("text_size", P.byte_size(F.col("text")))
    return df.select("doc_id", B.row_weight({"text": "text_size", "source": 512}, ["text", "source", "lang"]).alias("weight"))


_SUMS = "SELECT block_number, CAST(sum(w) AS BIGINT) AS weight FROM (SELECT block_number, data_size + 32 AS w FROM logs UNION ALL SELECT block_number, 64 FROM txs UNION ALL SELECT number, 0 FROM blocks) GROUP BY 1"


def weights(lake):
    logs = lake.logs().select("block_number", B.row_weight({"data": "data_size"}, ["data", "address"]).alias("weight"))
    txs = lake.transactions().select("block_number", B.row_weight({}, ["from", "type"]).alias("weight"))
    return B.block_weights([logs, txs], B.include_all(lake.blocks()))


@query(_SUMS, "logs", "txs", "blocks")
def block_weights(lake):
    return weights(lake)


@query(f"SELECT block_number, CAST(weight + 32 * 3 + number % 7 AS BIGINT) AS weight FROM ({_SUMS}) JOIN blocks ON number = block_number", "logs", "txs", "blocks")
def header_weight(lake):
    return B.header_weight(weights(lake), lake.blocks().withColumn("extra", F.col("number") % 7), B.row_weight({"x": "extra"}, ["a", "b", "c", "x"]))


_CUT = "SELECT block_number, weight FROM (SELECT block_number, weight, coalesce(sum(weight) OVER ({part} ORDER BY block_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ({sums})) WHERE before <= {limit}"


@query(_CUT.format(part="PARTITION BY block_number // 100", sums=_SUMS, limit=9000), "logs", "txs", "blocks")
def budget_cut_per_chunk(lake):
    return B.budget_cut(weights(lake).withColumn("chunk", F.floor(F.col("block_number") / 100)), 9000).select("block_number", "weight")


@query(_CUT.format(part="", sums=_SUMS, limit=150_000), "logs", "txs", "blocks")
def budget_cut_global(lake):
    return B.budget_cut(weights(lake).withColumn("chunk", F.floor(F.col("block_number") / 100)), 150_000, per=None).select("block_number", "weight")


@query("SELECT block_number, string_agg(transaction_index || ':' || log_index || ':' || address, ',' ORDER BY transaction_index, log_index) AS items FROM logs GROUP BY 1", "logs")
def collect_items_ordered(lake):
    item = F.concat_ws(":", "transaction_index", "log_index", "address")
    return A.collect_items(lake.logs(), LOG, item).select("block_number", F.array_join("items", ",").alias("items"))


_FLAGSHIP = """, hit AS (SELECT * FROM logs WHERE address = 7 AND block_number BETWEEN 100 AND 2200), tx AS (SELECT DISTINCT t.* FROM txs t JOIN hit USING (block_number, transaction_index)),
shown AS (SELECT number, day FROM blocks WHERE number BETWEEN 100 AND 2200 AND (number IN (SELECT block_number FROM hit) OR number IN (SELECT unnest([min(number), max(number)]) FROM blocks WHERE number BETWEEN 100 AND 2200)))
SELECT number AS block_number, CAST(day AS VARCHAR) AS day, coalesce((SELECT string_agg(transaction_index || ':' || log_index || ':' || topic0, ',' ORDER BY transaction_index, log_index) FROM hit WHERE block_number = number), '') AS logs,
coalesce((SELECT string_agg(transaction_index || ':' || type, ',' ORDER BY transaction_index) FROM tx WHERE block_number = number), '') AS transactions FROM shown"""


@query(_FLAGSHIP, "blocks", "txs", "logs")
def flagship(lake):
    """Logs of one address in a range of heights, with their transactions, grouped by block, and the range's ends."""
    headers = predicates.where(lake.blocks(), predicates.block_range(100, 2200, "number"))
    hits = predicates.where(lake.logs(), predicates.all_of([predicates.field_in("address", [7]), predicates.block_range(100, 2200)]))
    txs = R.select_items(lake.transactions(), [R.ref_parent(hits, TX, TX)], TX)
    log_lists = A.collect_items(hits, LOG, F.concat_ws(":", "transaction_index", "log_index", "topic0"), "logs")
    tx_lists = A.collect_items(txs, TX, F.concat_ws(":", "transaction_index", "type"), "transactions")
    wanted = R.union_keys([log_lists.select("block_number"), B.boundary_blocks(headers)]).distinct()
    chosen = headers.join(wanted, headers["number"] == wanted["block_number"], "left_semi")
    blocks = A.assemble_blocks(chosen, {"logs": log_lists, "transactions": tx_lists}, F.struct("day"))
    return blocks.select("block_number", F.col("header.day").cast("string").alias("day"), F.array_join("logs", ",").alias("logs"), F.array_join("transactions", ",").alias("transactions"))


@query(_FLAGSHIP.split("SELECT number AS block_number")[0] + "SELECT number AS block_number, (SELECT count(*) FROM hit WHERE block_number = number) AS n_logs, (SELECT count(*) FROM tx WHERE block_number = number) AS n_txs FROM shown", "blocks", "txs", "logs")
def request_blocks(lake):
    """The flagship as a request: what the builder makes of it, from the model of a chain."""
    named = lambda df, height: df.withColumns({"hash": F.concat(F.lit("h"), height), "parent_hash": F.concat(F.lit("h"), height - 1)})
    tables = {"blocks": named(lake.blocks(), F.col("number")), "logs": lake.logs(), "transactions": lake.transactions()}
    request = {"fromBlock": 100, "toBlock": 2200, "logs": [{"address": [7], "transaction": True}], "fields": {"log": {"topics": True}, "transaction": {"type": True}}}
    out = build.query(EVM, tables.__getitem__, request)
    return out.select("block_number", F.size("logs").cast("long").alias("n_logs"), F.size("transactions").cast("long").alias("n_txs"))


@query("SELECT number AS block_number, (SELECT count(*) FROM txs WHERE block_number = number AND type = '2-HIGH') AS n_txs, (SELECT count(*) FROM logs WHERE block_number = number AND address = 3) AS n_logs FROM blocks", "blocks", "txs", "logs")
def assemble_blocks(lake):
    txs = A.collect_items(lake.transactions().where("type = '2-HIGH'"), TX, "transaction_index", "txs")
    logs = A.collect_items(lake.logs().where("address = 3"), LOG, "log_index", "logs")
    out = A.assemble_blocks(lake.blocks(), {"txs": txs, "logs": logs})
    return out.select("block_number", F.size("txs").cast("long").alias("n_txs"), F.size("logs").cast("long").alias("n_logs"))


@query("SELECT number AS block_number FROM blocks WHERE number BETWEEN 300 AND 900", "blocks")
def include_all_blocks(lake):
    return B.include_all(predicates.where(lake.blocks(), predicates.block_range(300, 900, "number")))


@query("SELECT DISTINCT unnest([min(number), max(number)]) AS block_number FROM blocks GROUP BY chunk", "blocks")
def boundary_blocks(lake):
    return B.boundary_blocks(lake.blocks(), per="chunk")


_PAGED = "SELECT doc_id // 100 AS chunk, doc_id AS block_number, coalesce(strlen(text), 0) AS size FROM documents"


def sized_documents(lake):
    return lake.table("documents").select(F.floor(F.col("doc_id") / 100).cast("long").alias("chunk"), F.col("doc_id").alias("block_number"), P.byte_size(F.col("text")).alias("size"))


@query(f"SELECT block_number, CAST(floor(coalesce(sum(size) OVER (PARTITION BY chunk ORDER BY block_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 20000) AS BIGINT) AS page FROM ({_PAGED})")
def paginate_bulk(lake):
    return B.paginate(sized_documents(lake), 20_000, exact=False).select("block_number", "page")


@query(f""", s AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY block_number) AS n FROM ({_PAGED})), g AS (
SELECT chunk, block_number, n, 0 AS page, size AS total FROM s WHERE n = 1 UNION ALL
SELECT s.chunk, s.block_number, s.n, g.page + CASE WHEN g.total > 20000 THEN 1 ELSE 0 END, CASE WHEN g.total > 20000 THEN 0 ELSE g.total END + s.size FROM g JOIN s ON s.chunk = g.chunk AND s.n = g.n + 1)
SELECT block_number, CAST(page AS BIGINT) AS page FROM g""", "blocks")
def paginate(lake):
    return B.paginate(sized_documents(lake), 20_000).select("block_number", "page")


@query(f"SELECT block_number, CAST(floor(coalesce(sum(size) OVER (ORDER BY block_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 200000) AS BIGINT) AS chunk FROM ({_PAGED})")
def assign_chunks_bulk(lake):
    return B.assign_chunks(sized_documents(lake).drop("chunk"), 200_000, bucket=100).select("block_number", "chunk")


# projections


@query("SELECT o_orderkey AS id, '{\"key\":' || o_orderkey || ',\"flag\":' || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '\"' || o_orderstatus || '\"' END || '}' AS j FROM orders")
def json_object_nulls(lake):
    flag = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), P.json_object(F.struct(F.col("o_orderkey").alias("key"), flag.alias("flag"))).alias("j"))


@query("SELECT o_orderkey AS id, CAST(o_orderkey * 9007199254 AS VARCHAR) AS v FROM orders")
def bigint_as_text(lake):
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), P.as_text(F.col("o_orderkey") * F.lit(9007199254)).alias("v"))


@query("SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def embedded_json(lake):
    return lake.table("events").select(F.col("event_id").alias("id"), F.try_variant_get(P.embedded_json(F.col("props")), "$.k", "bigint").alias("k"))


@query("SELECT event_id AS id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS s FROM events")
def epoch_seconds(lake):
    return lake.table("events").select(F.col("event_id").alias("id"), P.epoch_seconds(F.col("ts")).alias("s"))


@query("SELECT event_id AS id, CAST(floor(epoch_us(ts) / 1000.0) AS BIGINT) AS ms FROM events")
def epoch_millis(lake):
    return lake.table("events").select(F.col("event_id").alias("id"), P.epoch_millis(F.col("ts")).alias("ms"))


@query("SELECT l_orderkey AS id, l_linenumber AS n, count(*) AS c, CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag || ',' END || l_linestatus AS v FROM lineitem GROUP BY ALL")
def compact_list(lake):
    v = P.compact_list(F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")), F.col("l_linestatus"), F.lit(None).cast("string"))
    return lake.table("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), F.array_join(v, ",").alias("v")).groupBy("id", "n", "v").agg(F.count("*").alias("c"))


@query("SELECT doc_id AS id, array_to_string(CASE WHEN len(w) > 3 THEN w ELSE w[1:3] END, ' ') AS v FROM (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents)")
def concat_rest_list(lake):
    w = F.split("text", "\n")
    columns, rest = I.split_list(w, 3)
    return lake.table("documents").select(F.col("doc_id").alias("id"), F.array_join(P.list_with_rest(columns, rest), " ").alias("v"))


@query("SELECT doc_id AS id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n FROM documents")
def byte_size(lake):
    return lake.table("documents").select(F.col("doc_id").alias("id"), P.byte_size(F.col("text")).alias("n"))


@query("SELECT extrinsic_index, array_to_string(address[1:1], '.') AS head, array_to_string(address[1:len(address) - 1], '.') AS parent, len(address) AS n FROM calls", "calls")
def list_prefix(lake):
    c = lake.calls().select("extrinsic_index", P.list_prefix(F.col("address"), 1).alias("h"), P.pop_back(F.col("address")).alias("p"), F.size("address").cast("long").alias("n"))
    return c.select("extrinsic_index", text("h").alias("head"), text("p").alias("parent"), "n")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'legacy' ELSE CAST(o_orderkey AS VARCHAR) END AS v FROM orders")
def version_or_legacy(lake):
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), P.version_or_legacy(F.when(F.col("o_orderkey") % 5 == 0, -1).otherwise(F.col("o_orderkey"))).alias("v"))


@query("SELECT o_orderkey AS id, '{\"v\":' || CASE WHEN o_orderkey % 5 = 0 THEN '\"legacy\"' ELSE CAST(o_orderkey AS VARCHAR) END || '}' AS j FROM orders")
def version_json(lake):
    version = P.version_json(F.when(F.col("o_orderkey") % 5 == 0, -1).otherwise(F.col("o_orderkey")))
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), F.to_json(F.struct(version.alias("v"))).alias("j"))


@query("SELECT event_id AS id, CASE event_type WHEN 'click' THEN '{\"user\":' || user_id || '}' WHEN 'view' THEN '{\"of\":\"' || user_id || '\"}' END AS v FROM events")
def tagged_union(lake):
    v = P.tagged(F.col("event_type"), {"click": {"user": F.col("user_id")}, "view": {"of": P.as_text(F.col("user_id"))}})
    return lake.table("events").select(F.col("event_id").alias("id"), F.to_json(v).alias("v"))


# layout and ranges


@query("SELECT first_block, last_block FROM catalog WHERE last_block >= 250 AND first_block <= 1210", "catalog")
def prune_chunks(lake):
    return layout.prune_chunks(lake.catalog(), 250, 1210).select("first_block", "last_block")


@query("SELECT dataset, first_block, last_block FROM catalog WHERE first_block <= 1210 ORDER BY first_block DESC LIMIT 1", "catalog")
def last_chunk(lake):
    return layout.last_chunk(lake.catalog(), None, 1210).select("dataset", "first_block", "last_block")


_BAD = "SELECT dataset, top, CASE WHEN chunk % 4 = 1 THEN first_block - 30 WHEN chunk % 7 = 3 THEN last_block + 5 ELSE first_block END AS first_block, CASE WHEN chunk % 5 = 4 THEN last_block + 20 ELSE last_block END AS last_block FROM catalog"


@query(f"""SELECT dataset, first_block, unnest(list_filter([CASE WHEN first_block > last_block THEN 'end_before_begin' END, CASE WHEN first_block < top THEN 'before_top' END, CASE WHEN first_block <= p THEN 'overlap' END, CASE WHEN nt > top AND last_block >= nt THEN 'crosses_top' END], lambda x: x IS NOT NULL)) AS error
FROM (SELECT *, lag(last_block) OVER w AS p, lead(top) OVER w AS nt FROM ({_BAD}) WINDOW w AS (PARTITION BY dataset ORDER BY first_block, last_block))""", "catalog")
def validate_layout(lake):
    c = lake.catalog()
    first = F.when(F.col("chunk") % 4 == 1, F.col("first_block") - 30).when(F.col("chunk") % 7 == 3, F.col("last_block") + 5).otherwise(F.col("first_block"))
    last = F.when(F.col("chunk") % 5 == 4, F.col("last_block") + 20).otherwise(F.col("last_block"))
    return layout.validate_layout(c.select("dataset", "top", first.alias("first_block"), last.alias("last_block")))


@query("SELECT dataset, max(last_block) + 1 AS next_block FROM catalog GROUP BY 1", "catalog")
def next_block(lake):
    return layout.next_block(lake.catalog())


@query("SELECT dataset, first_block, last_block FROM catalog WHERE chunk % 3 <> 0", "catalog")
def incomplete_chunks(lake):
    c = lake.catalog()
    files = c.select("dataset", "first_block", F.when(F.col("chunk") % 3 == 0, "blocks.parquet").otherwise("logs.parquet").alias("name"))
    return layout.incomplete_chunks(c, files).select("dataset", "first_block", "last_block")


@query("SELECT dataset, unnest(list_filter([CASE WHEN min(first_block) <> 5 THEN 'begins_elsewhere' END, CASE WHEN max(last_block) > 1000 THEN 'ends_after' END], lambda x: x IS NOT NULL)) AS conflict FROM catalog GROUP BY 1", "catalog")
def range_conflicts(lake):
    return layout.range_conflicts(lake.catalog(), 5, 1000)


_HEIGHTS = "SELECT DISTINCT dataset, unnest(range(beg, \"end\" + 1)) AS h FROM {}"
_ISLANDS = "SELECT dataset, min(h) AS beg, max(h) AS \"end\" FROM (SELECT dataset, h, h - row_number() OVER (PARTITION BY dataset ORDER BY h) AS g FROM ({})) GROUP BY dataset, g"


@query(_ISLANDS.format(_HEIGHTS.format("ra")), "ra")
def merge_ranges(lake):
    return ranges.merge_ranges(lake.ranges(0, 3, 50))


@query(_ISLANDS.format(f"{_HEIGHTS.format('ra')} EXCEPT {_HEIGHTS.format('rb')}"), "ra", "rb")
def subtract_ranges(lake):
    return ranges.subtract_ranges(lake.ranges(0, 3, 50), lake.ranges(7, 7, 40))


@query(_ISLANDS.format(f"{_HEIGHTS.format('ra')} INTERSECT {_HEIGHTS.format('rb')}"), "ra", "rb")
def intersect_ranges(lake):
    return ranges.intersect_ranges(lake.ranges(0, 3, 50), lake.ranges(7, 7, 40), width=64)


@query(" UNION ALL ".join(f"SELECT *, '{kind}' AS kind FROM ({_ISLANDS.format(f'{_HEIGHTS.format(a)} {op} {_HEIGHTS.format(b)}')})" for kind, a, op, b in (("new", "ra", "EXCEPT", "rb"), ("deletable", "rb", "EXCEPT", "ra"), ("needed", "ra", "INTERSECT", "rb"))), "ra", "rb")
def coverage_report(lake):
    return ranges.coverage(lake.ranges(0, 3, 50), lake.ranges(7, 7, 40))


@query(f"SELECT p.dataset, p.n, m.beg, m.\"end\" FROM (SELECT c_mktsegment AS dataset, c_custkey * 11 + 15 AS n FROM customer) p JOIN ({_ISLANDS.format(_HEIGHTS.format('rb'))}) m ON p.dataset = m.dataset AND p.n BETWEEN m.beg AND m.\"end\"", "rb")
def find_range(lake):
    points = lake.table("customer").select(F.col("c_mktsegment").alias("dataset"), (F.col("c_custkey") * 11 + 15).alias("n"))
    return ranges.find_range(ranges.merge_ranges(lake.ranges(7, 7, 40)), points, width=64).select("dataset", "n", "beg", "end")


@query("SELECT unnest(range(min(number), max(number) + 1)) AS number FROM blocks EXCEPT SELECT number FROM blocks", "blocks")
def missing_blocks(lake):
    return ranges.missing_blocks(lake.blocks(), bucket=500)


_COLUMNS = {"orders": {"o_orderkey": "bigint", "o_totalprice": "double", "call": "int"}, "documents": {"doc_id": "bigint", "text": "string", "lang": "string"}, "nation": {"n_name": "string"}}
_EACH = {"call": "CASE WHEN o_orderstatus <> 'P' THEN 1 END"}


@query(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{kind}' AS type, count(*) > count({_EACH.get(c, c)}) AS nullable, count(*) - count({_EACH.get(c, c)}) AS nulls FROM {t}" for t, columns in _COLUMNS.items() for c, kind in columns.items()))
def dataset_metadata(lake):
    o = lake.table("orders").withColumn("call", F.when(F.col("o_orderstatus") != "P", 1))
    return layout.dataset_metadata({"orders": o.select(*_COLUMNS["orders"]), "documents": lake.table("documents").select(*_COLUMNS["documents"]), "nation": lake.table("nation").select("n_name")})


@query("SELECT first_block, last_block, row_number() OVER (ORDER BY first_block DESC) AS place FROM catalog", "catalog")
def chunks_desc(lake):
    listed = layout.chunks_desc(lake.catalog()).select(F.collect_list(F.struct("first_block", "last_block")).alias("c"))
    return listed.select(F.posexplode("c").alias("pos", "c")).select("c.first_block", "c.last_block", (F.col("pos") + 1).cast("long").alias("place"))


@query("SELECT dataset, first_block, last_block, min(first_block) OVER (PARTITION BY dataset, n // 4) AS top FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY first_block) - 1 AS n FROM catalog)", "catalog")
def assign_tops(lake):
    return B.assign_tops(lake.catalog().drop("top"), 4).select("dataset", "first_block", "last_block", "top")


@query("SELECT DISTINCT unnest([greatest(first_block, 120), least(last_block, 2010)]) AS block_number FROM catalog WHERE first_block <= 2010 AND last_block >= 120", "catalog")
def chunk_ends(lake):
    return B.chunk_ends(lake.catalog(), 120, 2010)


@query("SELECT block_number, transaction_index, log_index, address FROM logs WHERE block_number BETWEEN 150 AND 1250", "logs")
def lake_round_trip(lake):
    """All three tables written in the layout of a lake, and a range of one read back through its catalog."""
    root = f"{shared_dir(lake.spark)}/lake-{uuid.uuid4().hex}"
    chunks = lake.catalog().withColumn("last_hash", F.lower(F.hex("last_block")))
    by_height = lambda df, height: df.withColumn("chunk", F.floor(F.col(height) / 100).cast("long"))
    specs = {"logs": TableSpec("logs", ("transaction_index", "log_index"), {}, ("address",))}
    sinks.write_lake({"blocks": lake.blocks(), "transactions": by_height(lake.transactions(), "block_number"), "logs": by_height(lake.logs(), "block_number")}, specs, chunks, root)
    return layout.read_table(lake.spark, root, "logs", 150, 1250, ["block_number", "transaction_index", "log_index", "address"])


def _logs_lake(lake) -> str:
    """The logs as a lake of their own."""
    root = f"{shared_dir(lake.spark)}/lake-{uuid.uuid4().hex}"
    rows = lake.logs().withColumn("chunk", F.floor(F.col("block_number") / 100).cast("long"))
    specs = {"logs": TableSpec("logs", ("transaction_index", "log_index"), {}, ("address",))}
    sinks.write_lake({"logs": rows}, specs, lake.catalog().withColumn("last_hash", F.lower(F.hex("last_block"))), root)
    return root


_FOOTERS = {"address": "bigint", "data_size": "bigint", "topic0": "string", "topic2": "string"}


@query(
    "SELECT first_block, c.* FROM catalog JOIN (" + " UNION ALL ".join(
        f"SELECT block_number // 100 AS chunk, '{c}' AS \"column\", '{kind}' AS type, count(*) AS rows, count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high FROM (SELECT *, CAST(NULL AS VARCHAR) AS topic2 FROM logs) GROUP BY 1"
        for c, kind in _FOOTERS.items()
    ) + ") c USING (chunk)", "catalog", "logs",
)
def footer_catalog(lake):
    """What the footers of a lake's logs tell of each chunk's columns."""
    told = footers.columns_of_chunks(footers.footers(lake.spark, _logs_lake(lake), "logs")).where(F.col("column").isin(list(_FOOTERS)))
    place = F.regexp_extract("path", f"/{layout.CHUNK}$", 2).cast("long")
    end = lambda side: F.coalesce(F.col(f"{side}_long").cast("string"), F.col(f"{side}_text")).alias(side)
    return told.select(place.alias("first_block"), (F.floor(place / 100)).cast("long").alias("chunk"), "column", "type", "rows", "nulls", end("low"), end("high"))


@query(" UNION ALL ".join(f"SELECT 'logs' AS \"table\", '{c}' AS \"column\", '{kind}' AS type, count(*) > count({c}) AS nullable, count(*) - count({c}) AS nulls FROM (SELECT *, CAST(NULL AS VARCHAR) AS topic2 FROM logs)" for c, kind in _FOOTERS.items()), "logs")
def footer_metadata(lake):
    """Types and nulls of the logs' columns, from footers alone."""
    return footers.metadata({"logs": footers.footers(lake.spark, _logs_lake(lake), "logs")}).where(F.col("column").isin(list(_FOOTERS)))


@query("SELECT block_number, transaction_index, log_index, address FROM logs WHERE transaction_index BETWEEN 100 AND 160 AND topic0 >= 'N'", "logs")
def skip_by_footers(lake):
    """Logs of some transactions, from the chunks that may have them."""
    return layout.read_table(lake.spark, _logs_lake(lake), "logs", columns=["block_number", "transaction_index", "log_index", "address"], within={"transaction_index": (100, 160), "topic0": ("N", None)})


@query("SELECT number, CAST(day AS VARCHAR) AS day FROM blocks WHERE number BETWEEN 150 AND 1250", "blocks")
def raw_round_trip(lake):
    """Blocks as gzip JSON lines, a folder for each megabyte or so, and a range of them read back."""
    dest = f"{shared_dir(lake.spark)}/raw-{uuid.uuid4().hex}"
    sinks.write_raw(lake.blocks().select("number", F.col("day").cast("string").alias("day")), dest, chunk_mb=1)
    return sinks.read_raw_blocks(lake.spark, dest, "number long, day string", 150, 1250)


# ingest and audits


@query("SELECT o_orderkey AS id, CASE WHEN length(o_orderpriority) >= 10 THEN substr(o_orderpriority, 1, 10) END AS s10, CASE WHEN length(o_orderpriority) >= 8 THEN substr(o_orderpriority, 1, 8) END AS s8 FROM orders")
def sighash(lake):
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), I.sighash(F.col("o_orderpriority")).alias("s10"), I.sighash(F.col("o_orderpriority"), 8).alias("s8"))


@query("SELECT doc_id AS id, w[1] AS c0, w[2] AS c1, CASE WHEN len(w) > 2 THEN array_to_string(w[3:], '|') END AS rest FROM (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents)")
def split_list(lake):
    (c0, c1), rest = I.split_list(F.split("text", "\n"), 2)
    return lake.table("documents").select(F.col("doc_id").alias("id"), c0.alias("c0"), c1.alias("c1"), F.array_join(rest, "|").alias("rest"))


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS event_index FROM events")
def event_index(lake):
    return I.event_index(lake.table("events"), "user_id", "event_id").select("event_id", F.col("event_index").cast("long").alias("event_index"))


@query("SELECT o_orderkey AS id, o_orderkey * 1099511627776 AS v, o_orderkey % 17 AS small, CAST(o_custkey AS BIGINT) AS t, CAST(CAST(o_orderkey AS HUGEINT) * 1152921504606846976 AS VARCHAR) AS d FROM orders")
def convert_quantities(lake):
    """Quantities are longs as long as all fit 63 bits, else decimals: from order 2^23 on a long has no room for them (there the SQL stops)."""
    hexed = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    o = lake.table("orders").select(F.col("o_orderkey").alias("id"), F.concat(hexed(F.col("o_orderkey")), F.lit("0" * 10)).alias("v"), F.concat(F.lit("0x000000000000000000"), F.hex(F.col("o_orderkey") % 17)).alias("small"), F.col("o_custkey").cast("string").alias("t"), F.concat(hexed(F.col("o_orderkey")), F.lit("0" * 15)).alias("d"))
    wide = (lake.table("orders").agg(F.max("o_orderkey")).first()[0] or 0) >= 1 << 23
    return I.convert_quantities(o, hexes=["small"] if wide else ["v", "small"], texts=["t"], wide=["v"] if wide else []).withColumn("d", I.hex_to_decimal(F.col("d")).cast("string"))


@query("SELECT doc_id AS id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS text_size, row_number() OVER (PARTITION BY source ORDER BY lang, doc_id) - 1 AS _idx FROM documents")
def add_sizes(lake):
    out = I.add_sizes(lake.table("documents"), ["text"], ["lang", "doc_id"], per="source")
    return out.select(F.col("doc_id").alias("id"), "text_size", F.col("_idx").cast("long").alias("_idx"))


def hashed(lake):
    """Blocks that link to the height before, but for some that do not."""
    h = lambda n: F.concat(F.lit("0x"), F.lpad(F.hex(n), 16, "0"))
    parent = F.when(F.col("number") % 50 == 7, F.col("number") + 3).otherwise(F.col("number") - 1)
    return lake.blocks().select("number", h(F.col("number")).alias("hash"), h(parent).alias("parent_hash"))


@query("SELECT number AS block_number FROM (SELECT number, lag(number) OVER (ORDER BY number) AS p, CASE WHEN number % 50 = 7 THEN number + 3 ELSE number - 1 END AS q FROM blocks) WHERE p IS NOT NULL AND p <> q", "blocks")
def audit_continuity(lake):
    return audit.audit_continuity(hashed(lake), "last5", bucket=100).select("block_number")


@query("SELECT block_number, transaction_index || '-' || log_index AS key FROM logs WHERE transaction_index % 4 = 0", "logs")
def audit_log_links(lake):
    txs = lake.transactions().where("transaction_index % 4 <> 0").withColumn("hash", F.col("transaction_index").cast("string"))
    return audit.audit_log_links(lake.logs().withColumn("transaction_hash", F.col("transaction_index").cast("string")), txs).select("block_number", "key")


@query("SELECT l.block_number, CAST(l.transaction_index AS VARCHAR) AS key FROM logs l WHERE NOT EXISTS (SELECT 1 FROM txs t WHERE t.status <> 'P' AND t.block_number = l.block_number AND t.transaction_index = l.transaction_index)", "logs", "txs")
def audit_links(lake):
    return audit.audit_links(lake.logs(), lake.transactions().where("status <> 'P'"), ["transaction_index"]).select("block_number", "key")


@query("SELECT block_number, CAST(transaction_index AS VARCHAR) AS key FROM txs WHERE status = 'P'", "txs")
def audit_missing_type(lake):
    return audit.audit_missing(lake.transactions().withColumn("type", F.when(F.col("status") != "P", F.col("type"))), "type", "transaction_index").select("block_number", "key")


@query("SELECT l_orderkey || '-' || l_linenumber AS key, CAST(count(*) AS VARCHAR) AS actual FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def audit_duplicates(lake):
    return audit.audit_duplicates(lake.table("lineitem"), ["l_orderkey", "l_linenumber"]).select("key", "actual")


@query("SELECT number AS block_number, CAST(coalesce(n, 0) AS VARCHAR) AS actual FROM blocks LEFT JOIN (SELECT block_number, count(*) AS n FROM txs GROUP BY 1) ON number = block_number WHERE coalesce(n, 0) <> number % 9", "blocks", "txs")
def audit_counts(lake):
    return audit.audit_counts(lake.blocks().withColumn("declared", F.col("number") % 9), lake.transactions(), "declared").select("block_number", "actual")


_STATE = "SELECT o_orderkey AS t, CASE WHEN o_custkey % 2 = 0 THEN 'balance' ELSE 'slot' END AS k, {value} AS v FROM orders WHERE {test}"


@query(f"""SELECT coalesce(a.t, b.t) AS transaction_index, coalesce(a.k, b.k) AS "key", CASE WHEN a.v IS NULL THEN '+' WHEN b.v IS NULL THEN '-' ELSE '*' END AS kind, a.v AS prev, b.v AS next
FROM ({_STATE.format(value="o_orderstatus", test="o_orderstatus <> 'P' OR o_custkey % 2 = 1")}) a FULL JOIN ({_STATE.format(value="CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus ELSE 'Z' END", test="o_orderstatus <> 'F'")}) b ON a.t = b.t AND a.k = b.k
WHERE NOT (coalesce(a.k, b.k) = 'balance' AND b.v IS NULL) AND a.v IS DISTINCT FROM b.v""")
def prestate_diff(lake):
    own = F.when(F.col("o_custkey") % 2 == 0, "balance").otherwise("slot")
    state = lambda test, value: lake.table("orders").where(test).select(F.lit(0).alias("block_number"), F.col("o_orderkey").alias("transaction_index"), F.lit("a").alias("address"), own.alias("key"), value.alias("value"))
    after = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderstatus")).otherwise("Z")
    # orders of status F are there before alone, some of status P afterwards alone, all others before and after
    out = I.prestate_diff(state("o_orderstatus <> 'P' OR o_custkey % 2 = 1", F.col("o_orderstatus")), state("o_orderstatus <> 'F'", after))
    return out.select("transaction_index", "key", "kind", "prev", "next")


@query("SELECT block_number, row_number() OVER (PARTITION BY block_number ORDER BY transaction_index) - 1 AS pos, transaction_index, type FROM txs", "txs")
def flatten_blocks(lake):
    tx = F.sort_array(F.collect_list(F.struct("transaction_index", "type"))).alias("transactions")
    raw = lake.transactions().groupBy(F.col("block_number").alias("number")).agg(tx)
    return I.flatten_blocks(raw, {"transactions": "transactions"})["transactions"].withColumn("pos", F.col("pos").cast("long"))


@query("""SELECT block_number, transaction_index, CASE WHEN block_number BETWEEN 1500 AND 1600 THEN '9-ALL' WHEN status = 'P' THEN CASE WHEN nonce % 2 = 0 THEN '0x2' ELSE '0x0' END ELSE type END AS type FROM txs
WHERE NOT (block_number <= 500 AND type = '5-LOW' AND status <> 'P') AND transaction_index <> 77 AND NOT (block_number BETWEEN 600 AND 700 AND nonce % 7 = 0) AND NOT (block_number BETWEEN 800 AND 900 AND nonce % 3 = 0) AND NOT (block_number = 1000 AND transaction_index < 3000)""", "txs")
def correction_rules(lake):
    rules = [
        ("c", 0, 500, None, "drop_type", "5-LOW"), ("c", 0, 10_000, "77", "drop", None), ("d", 0, 10_000, None, "drop", None), ("c", 600, 700, None, "drop_zero_address", None),
        ("c", 800, 900, None, "drop_duplicated", None), ("c", 1000, 1000, None, "slice", "3000"), ("c", 0, 10_000, None, "fill_type_by", "fee"), ("c", 1500, 1600, None, "set_type", "9-ALL"),
    ]
    zero = F.when(F.col("nonce") % 7 == 0, I.ZERO_ADDRESS).otherwise("0x1")
    txs = lake.transactions().withColumns({
        "hash": F.col("transaction_index").cast("string"), "type": F.when(F.col("status") != "P", F.col("type")), "fee": F.when(F.col("nonce") % 2 == 0, 1), "from": zero, "to": zero,
        "block_hash": F.lit("own"), "receipt_block_hash": F.when(F.col("nonce") % 3 == 0, "other").otherwise("own"),
    })
    return I.apply_rules(txs, lake.spark.createDataFrame(rules, I.RULES), "c").select("block_number", "transaction_index", "type")


@query("SELECT event_id AS id, json_extract_string(props, '$.k') AS _k FROM events")
def hidden_index(lake):
    return I.hidden_index(lake.table("events"), {"_k": "$.k"}, "props").select(F.col("event_id").alias("id"), "_k")


@query("SELECT event_id AS id, CASE event_type WHEN 'click' THEN json_extract_string(props, '$.k') END AS click_k, CASE event_type WHEN 'view' THEN json_extract_string(props, '$.k') END AS view_k FROM events")
def unpack_union(lake):
    tag = F.when(F.col("event_type").isin("click", "view"), F.col("event_type"))
    columns = I.unpack_union(F.col("props"), tag, {"click": {"click_k": "$.k"}, "view": {"view_k": "$.k"}})
    return lake.table("events").select(F.col("event_id").alias("id"), *[c.alias(k) for k, c in columns.items()])


_RECEIPTS = """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN o_orderkey * 16 END AS gas_used, CASE WHEN o_orderstatus = 'F' THEN o_custkey % 3 END AS type,
CASE WHEN o_orderstatus = 'F' THEN o_custkey % 2 WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_custkey % 5 = 0 OR o_custkey % 4 = 3 THEN 0 ELSE 1 END ELSE CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE 1 END END AS status,
CASE WHEN o_orderstatus = 'F' THEN 'r' || o_orderkey WHEN o_orderstatus = 'O' AND o_custkey % 5 <> 0 AND (CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 4 IN (1, 2) ELSE o_custkey % 4 = 1 END) THEN 'n' || o_custkey END AS contract_address FROM orders"""


@query(_RECEIPTS)
def receipt_columns(lake):
    """Orders of status F have a receipt of their own block, those of status P one of another; the rest has a frame or a trace."""
    o, hexed = lake.table("orders"), lambda c: F.concat(F.lit("0x"), F.hex(c))
    failed = F.when(F.col("o_custkey") % 5 == 0, F.lit("reverted"))
    of = lambda *kinds: F.element_at(F.array(*map(F.lit, kinds)), (F.col("o_custkey") % 4 + 1).cast("int"))
    new, traced = F.concat(F.lit("n"), F.col("o_custkey")), F.col("o_orderstatus") == "O"
    frame = F.when(traced & (F.col("o_orderkey") % 2 == 0), F.struct(of("CALL", "CREATE", "CREATE2", "INVALID").alias("type"), failed.alias("error"), new.alias("to")))
    trace = F.when(traced & (F.col("o_orderkey") % 2 == 1), F.struct(of("call", "create", "suicide", "reward").alias("type"), failed.alias("error"), new.alias("address")))
    txs = o.select(F.col("o_orderkey").alias("hash"), F.to_date("o_orderdate").cast("string").alias("block_hash"), frame.alias("frame"), trace.alias("trace"))
    block = F.when(F.col("o_orderstatus") == "P", F.lit("another")).otherwise(F.to_date("o_orderdate").cast("string"))
    receipts = o.where("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("transactionHash"), block.alias("blockHash"), hexed(F.col("o_orderkey") * 16).alias("gasUsed"), hexed(F.col("o_custkey") % 3).alias("type"), hexed(F.col("o_custkey") % 2).alias("status"), F.concat(F.lit("r"), F.col("o_orderkey")).alias("contractAddress"))
    got = I.with_receipts(txs, receipts)
    return got.select(F.col("hash").alias("id"), I.hex_to_int(F.col("gas_used")).alias("gas_used"), F.col("type").cast("long").alias("type"), F.col("status").cast("long").alias("status"), "contract_address")


def logs_of_tx(lake, item):
    """A row a transaction with the list of its logs, in order."""
    each = F.sort_array(F.collect_list(F.struct("log_index", *[c.alias(k) for k, c in item.items()])))
    return lake.logs().groupBy("block_number", "transaction_index").agg(F.transform(each, lambda x: x.dropFields("log_index")).alias("each"))


_FRAME_SQL = """SELECT transaction_index, '' AS at, CAST(count(*) FILTER (log_index <> 2) AS BIGINT) AS subtraces, 'call' AS type, 'call' AS call_type, 'top' AS "from" FROM logs GROUP BY 1
UNION ALL SELECT transaction_index, CAST(log_index - CASE WHEN log_index > 2 THEN 1 ELSE 0 END AS VARCHAR), 0, CASE topic0 WHEN 'A' THEN 'create' WHEN 'R' THEN 'suicide' ELSE 'call' END, CASE topic0 WHEN 'N' THEN 'delegatecall' END, CAST(address AS VARCHAR) FROM logs WHERE log_index <> 2"""


@query(_FRAME_SQL, "logs")
def flatten_call_frames(lake):
    kind = F.when(F.col("log_index") == 2, "STOP").when(F.col("topic0") == "A", "CREATE2").when(F.col("topic0") == "R", "SELFDESTRUCT").otherwise("DELEGATECALL")
    calls = logs_of_tx(lake, {"type": kind, "from": F.col("address").cast("string")})
    frames = calls.select("transaction_index", F.to_json(F.struct(F.lit("CALL").alias("type"), F.lit("top").alias("from"), F.col("each").alias("calls"))).alias("frame"))
    out = I.flatten_call_frames(frames, key=("transaction_index",))
    return out.select("transaction_index", text("trace_address").alias("at"), F.col("subtraces").cast("long").alias("subtraces"), "type", "call_type", "from")


@query("""SELECT transaction_index, 'validate' AS kind, '0' AS at, 1 AS n_events, 0 AS first_event FROM logs GROUP BY 1 UNION ALL SELECT transaction_index, 'execute', '1', 0, 1 FROM logs GROUP BY 1
UNION ALL SELECT transaction_index, 'execute', '1.' || (2 + log_index), data_size % 3, CAST(1 + coalesce(sum(data_size % 3) OVER (PARTITION BY transaction_index ORDER BY log_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) FROM logs""", "logs")
def unwrap_invocations(lake):
    calls = logs_of_tx(lake, {"events": F.array_repeat(F.lit("e"), (F.col("data_size") % 3).cast("int"))})
    root = F.struct(F.struct(F.array(F.lit("e")).alias("events")).alias("validate_invocation"), F.struct(F.col("each").alias("calls")).alias("execute_invocation"))
    out = I.unwrap_invocations(calls.select("transaction_index", F.to_json(root).alias("trace")), key=("transaction_index",))
    return out.select("transaction_index", F.col("invocation_type").alias("kind"), text("trace_address").alias("at"), F.col("n_events").cast("long").alias("n_events"), F.col("first_event").cast("long").alias("first_event"))


@query("""SELECT transaction_index, log_index, CASE topic0 WHEN 'A' THEN 'create' WHEN 'N' THEN 'call' ELSE 'suicide' END AS type, CASE topic0 WHEN 'A' THEN address END AS create_from, CASE topic0 WHEN 'N' THEN address END AS call_to,
CASE topic0 WHEN 'N' THEN '0x' || lpad(CAST(address AS VARCHAR), 8, '0') END AS call_sighash, CASE topic0 WHEN 'A' THEN 'code' END AS create_result_code, CASE topic0 WHEN 'R' THEN data_size END AS suicide_balance FROM logs""", "logs")
def flatten_parity_traces(lake):
    members = {c: F.col("address").cast("string") for c in ("from", "to", "address", "refundAddress", "author")}
    members |= {c: F.col("data_size").cast("string") for c in ("value", "gas", "balance")} | {"init": F.lit("i"), "rewardType": F.lit("r"), "input": F.concat(F.lit("0x"), F.lpad(F.col("address").cast("string"), 8, "0"), F.lit("ffff"))}
    kind = F.when(F.col("topic0") == "A", "create").when(F.col("topic0") == "N", "call").otherwise("suicide")
    result = F.struct(F.lit("a").alias("address"), F.lit("code").alias("code"), F.lit("1").alias("gasUsed"), F.lit("o").alias("output"))
    trace = {"transactionPosition": F.col("transaction_index"), "traceAddress": F.array(F.col("log_index").cast("int")), "subtraces": F.lit(0), "type": kind, "error": F.lit(None).cast("string"), "action": F.struct(*[c.alias(k) for k, c in members.items()]), "result": result}
    rows = lake.logs().groupBy("block_number").agg(F.collect_list(F.struct(*[c.alias(k) for k, c in trace.items()])).alias("traces"))
    out = I.flatten_parity_traces(rows)
    return out.select("transaction_index", F.col("trace_address")[0].cast("long").alias("log_index"), "type", F.col("create_from").cast("long").alias("create_from"), F.col("call_to").cast("long").alias("call_to"), "call_sighash", "create_result_code", F.col("suicide_balance").cast("long").alias("suicide_balance"))


@query("""SELECT o_orderkey AS transaction_index, CASE o_orderstatus WHEN 'F' THEN '+' WHEN 'O' THEN '*' ELSE '-' END AS kind, CASE o_orderstatus WHEN 'O' THEN 'f' || o_custkey WHEN 'P' THEN 'p' || o_custkey END AS prev,
CASE o_orderstatus WHEN 'F' THEN 'n' || o_custkey WHEN 'O' THEN 't' || o_custkey END AS next FROM orders WHERE o_orderkey % 3 <> 0""")
def parity_state_diff(lake):
    value = lambda p: F.concat(F.lit(p), F.col("o_custkey"))
    one = lambda sign, c: F.to_json(F.struct(c.alias(sign)))
    changed = one("*", F.struct(value("f").alias("from"), value("t").alias("to")))
    diff = F.when(F.col("o_orderkey") % 3 == 0, F.lit('"="')).when(F.col("o_orderstatus") == "F", one("+", value("n"))).when(F.col("o_orderstatus") == "P", one("-", value("p"))).otherwise(changed)
    rows = lake.table("orders").select(F.lit(0).alias("block_number"), F.col("o_orderkey").alias("transaction_index"), F.lit("a").alias("address"), F.lit("balance").alias("key"), diff.alias("diff"))
    return I.parity_state_diff(rows).select("transaction_index", "kind", "prev", "next")


@query("SELECT transaction_index, string_agg(lower(topic0) || address, ',' ORDER BY log_index) AS found FROM logs GROUP BY 1", "logs")
def choose_logs(lake):
    rows = logs_of_tx(lake, {"address": F.concat("topic0", F.col("address").cast("string"))})
    own = F.when(F.col("transaction_index") % 2 == 0, F.col("each"))
    found = I.choose_logs(own, F.array(F.slice("each", 1, 2), F.slice("each", 3, 1000)))
    return rows.select("transaction_index", F.array_join(F.transform(found, lambda x: x["address"]), ",").alias("found"))


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'w' || o_custkey END AS owner, CASE WHEN o_orderstatus = 'F' THEN 'to' || o_orderkey END AS target, CASE WHEN o_orderstatus = 'O' THEN 'w' || o_custkey END AS caller,
CASE WHEN o_orderstatus = 'O' AND length(o_orderpriority) >= 8 THEN substr(o_orderpriority, 1, 8) END AS sighash FROM orders""")
def contract_parameters(lake):
    value = F.struct(F.concat(F.lit("w"), F.col("o_custkey")).alias("owner_address"), F.concat(F.lit("to"), F.col("o_orderkey")).alias("to_address"), F.lit("c").alias("contract_address"), F.col("o_orderpriority").alias("data"))
    kind = F.when(F.col("o_orderstatus") == "F", "TransferContract").when(F.col("o_orderstatus") == "O", "TriggerSmartContract").otherwise("VoteWitnessContract")
    columns = I.contract_parameters(F.to_json(F.struct(value.alias("value"))), kind)
    names = {"owner": "_transfer_contract_owner", "target": "_transfer_contract_to", "caller": "_trigger_smart_contract_owner", "sighash": "_trigger_smart_contract_sighash"}
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), *[columns[c].alias(k) for k, c in names.items()])


@query("SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS energy_fee, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS kind FROM orders")
def normalise_struct(lake):
    raw = F.when(F.col("o_orderstatus") != "P", F.to_json(F.struct(F.col("o_custkey").alias("energyFee"), F.col("o_orderpriority").alias("resultKind"))))
    own = I.normalise_struct(raw, ("energyFee",), ("resultKind",), {"resultKind": "kind"})
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), own.alias("s")).select("id", "s.energy_fee", "s.kind")


@query("SELECT l.transaction_index, l.log_index, l.address FROM logs l JOIN txs t ON l.transaction_index = t.transaction_index WHERE t.status <> 'P'", "logs", "txs")
def trace_children(lake):
    calls = logs_of_tx(lake, {"address": F.col("address")})
    status = lake.transactions().select("transaction_index", F.when(F.col("status") == "P", "reverted").alias("revert_reason"))
    traces = calls.join(status, "transaction_index").select("block_number", "transaction_index", F.array().cast("array<int>").alias("trace_address"), "revert_reason", F.col("each").alias("events"))
    return I.trace_children(traces, "events").select("transaction_index", F.col("pos").cast("long").alias("log_index"), "address")


@query("SELECT block_number, transaction_index, log_index, 'traced' AS origin FROM logs WHERE block_number % 2 = 0 UNION ALL SELECT block_number, transaction_index, log_index, 'flat' FROM logs WHERE block_number % 2 <> 0", "logs")
def prefer_traced(lake):
    rows = lake.logs().select("block_number", "transaction_index", "log_index")
    return I.prefer_traced(rows.withColumn("origin", F.lit("flat")), rows.where("block_number % 2 = 0").withColumn("origin", F.lit("traced")))


@query("SELECT block_number, CAST(transaction_index AS VARCHAR) AS address, log_index AS \"key\", address AS value FROM logs", "logs")
def explode_state_updates(lake):
    slots = logs_of_tx(lake, {"key": F.col("log_index"), "value": F.col("address")})
    diffs = slots.groupBy(F.col("block_number").alias("number")).agg(F.collect_list(F.struct(F.col("transaction_index").cast("string").alias("address"), F.col("each").alias("storage_entries"))).alias("storage_diffs"))
    return I.explode_state_updates(diffs.select("number", F.struct(F.lit("root").alias("new_root"), "storage_diffs").alias("state_update")))[1]


@query("SELECT block_number, transaction_index, transaction_index * 10 AS trace FROM txs WHERE type <> '5-LOW'", "txs")
def zip_traces(lake):
    each = F.sort_array(F.collect_list(F.struct("transaction_index", "type")))
    rows = lake.transactions().groupBy("block_number").agg(each.alias("transactions"))
    traces = F.transform(F.filter("transactions", lambda t: t["type"] != "5-LOW"), lambda t: t["transaction_index"] * 10)
    same, odd = I.zip_traces(rows.withColumn("traces", traces), special=lambda t: t["type"] == "5-LOW")
    found = same.select("block_number", F.col("transaction.transaction_index").alias("transaction_index"), "trace")
    return found.unionByName(odd.select("block_number", F.lit(-1).cast("long").alias("transaction_index"), F.col("traces").cast("long").alias("trace")))


@query("SELECT block_number, transaction_index, 2 * transaction_index AS trace_index FROM (SELECT block_number, row_number() OVER (PARTITION BY block_number ORDER BY transaction_index) - 1 AS transaction_index FROM txs)", "txs")
def align_traces(lake):
    order = Window.partitionBy("block_number").orderBy("transaction_index")
    tx = lake.transactions().select("block_number", (F.row_number().over(order) - 1).cast("int").alias("transaction_index"), F.col("from").cast("string").alias("from"), F.col("type").alias("to"), F.col("transaction_index").cast("string").alias("value"))
    of_tx = tx.select("block_number", (F.col("transaction_index") * 2).alias("trace_index"), "from", "to", "value")
    between = of_tx.withColumns({"trace_index": F.col("trace_index") + 1, "from": F.lit("nobody")})
    return I.align_traces(tx, of_tx.unionByName(between)).select("block_number", F.col("transaction_index").cast("long").alias("transaction_index"), F.col("trace_index").cast("long").alias("trace_index"))


@query("SELECT o_orderkey AS id, '{\"amount\":' || o_custkey || ',\"unit\":' || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '\"' || o_orderstatus || '\"' END || '}' AS fee FROM orders")
def struct_of_columns(lake):
    fee = P.struct_of({"amount": F.col("o_custkey"), "unit": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))})
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), P.json_object(fee).alias("fee"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN '{\"tip\":\"' || o_custkey || '\",\"maturity\":' || o_orderkey || '}' END AS policies FROM orders")
def rekeyed_struct(lake):
    raw = F.when(F.col("o_orderstatus") != "P", F.struct(F.col("o_custkey").alias("tip_"), F.col("o_orderkey").alias("maturity_")))
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), raw.alias("raw")).select("id", P.json_object(P.rekeyed(F.col("raw"), {"tip_": "tip", "maturity_": "maturity"}, ("tip_",))).alias("policies"))


@query("SELECT o_orderkey AS id, '{\"v\":' || CASE WHEN o_orderkey * 9007199254740 <= 9007199254740991 THEN CAST(o_orderkey * 9007199254740 AS VARCHAR) ELSE '\"' || (o_orderkey * 9007199254740) || '\"' END || '}' AS j FROM orders")
def safe_integer(lake):
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), F.to_json(F.struct(P.safe_integer(F.col("o_orderkey").cast("decimal(19,0)") * F.lit(9007199254740).cast("decimal(13,0)")).alias("v"))).alias("j"))


@query("SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN '{\"from\":' || o_custkey || '}' WHEN 'O' THEN '{\"address\":\"' || o_orderpriority || '\"}' END AS action FROM orders")
def trace_members(lake):
    action, _ = P.trace_members(F.col("o_orderstatus"), {"F": {"from": F.col("o_custkey"), "to": F.lit(None).cast("string")}, "O": {"address": F.col("o_orderpriority")}}, {})
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), action.alias("action"))


_KIND = "CASE o_orderstatus WHEN 'F' THEN 'call' WHEN 'O' THEN 'create' ELSE 'reward' END"


@query(f"""SELECT o_orderkey AS id, '{{"transactionIndex":' || o_orderkey || ',"type":"' || {_KIND} || '"' || CASE {_KIND}
WHEN 'call' THEN ',"action":{{"from":"' || o_custkey || '"}}' || CASE WHEN o_custkey % 2 = 0 THEN ',"result":{{"output":"' || o_orderpriority || '"}}' ELSE '' END
WHEN 'create' THEN ',"action":' || CASE WHEN o_custkey % 2 = 0 THEN '{{"value":"' || o_custkey || '"}}' ELSE '{{}}' END ELSE '' END || '}}' AS j FROM orders""")
def trace_json(lake):
    """Traces as a request's result has them: members by the row's type inside action and result."""
    kind = F.when(F.col("o_orderstatus") == "F", "call").when(F.col("o_orderstatus") == "O", "create").otherwise("reward")
    even = lambda c: F.when(F.col("o_custkey") % 2 == 0, c)
    rows = lake.table("orders").select(F.col("o_orderkey").alias("transaction_index"), kind.alias("type"), F.col("o_custkey").cast("string").alias("call_from"), even(F.col("o_orderpriority")).alias("call_result_output"), even(F.col("o_custkey").cast("string")).alias("create_value"))
    return rows.select(F.col("transaction_index").alias("id"), build._trace(["transactionIndex", "type", "callFrom", "callResultOutput", "createValue"]).alias("j"))


@query("SELECT o_orderkey AS id, o_orderstatus AS type, CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS VARCHAR) WHEN 'O' THEN CAST(o_custkey + 1 AS VARCHAR) END AS amount, CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'P' THEN o_clerk END AS \"to\" FROM (SELECT *, o_orderpriority || '!' AS o_clerk FROM orders)")
def variant_fields(lake):
    """Members of a tagged union as a request's result has them: one name for those of all variants."""
    of = lambda status, c: F.when(F.col("o_orderstatus") == status, c)
    rows = lake.table("orders").select(F.col("o_orderkey").alias("index"), F.col("o_orderstatus").alias("type"), of("F", F.col("o_custkey")).alias("coin_amount"), of("O", F.col("o_custkey") + 1).alias("change_amount"), of("F", F.col("o_orderpriority")).alias("coin_to"), of("P", F.concat("o_orderpriority", F.lit("!"))).alias("variable_to"))
    made = build._variant(["index", "type", "coinAmount", "changeAmount", "coinTo", "variableTo"])
    return rows.select(made["index"].alias("id"), *[made[c].alias(c) for c in ("type", "amount", "to")])


@query("SELECT doc_id AS id, CAST(length(replace(text, chr(10), '')) AS BIGINT) AS n FROM documents")
def list_size(lake):
    return lake.table("documents").select(F.col("doc_id").alias("id"), P.list_size(F.split("text", "\n")).alias("n"))


@query("SELECT doc_id // 100 AS chunk, doc_id % 100 // 30 AS page, sha256(string_agg(source, chr(10) ORDER BY doc_id)) AS sha256 FROM documents GROUP BY 1, 2")
def page_digests(lake):
    d = lake.table("documents")
    pages = d.select(F.floor(F.col("doc_id") / 100).alias("chunk"), F.floor(F.col("doc_id") % 100 / 30).alias("page"), F.col("doc_id").alias("block_number"), F.col("source").alias("value"))
    return sinks.page_digests(pages)


# chain ingest: nested rows made of the given tables, by the rules of a chain's tables


def _hex(c):
    return F.concat(F.lit("0x"), F.lower(F.hex(c)))


#: Keys of orders that a raw line has at most: with all orders of a day in one line, lines would grow with the table.
LINE_KEYS = 1 << 14


def _raw_orders(lake):
    """Blocks of orders as nodes deliver them: quantities in hex, receipts with their logs inside; a line a height and stretch of keys."""
    log = F.struct(_hex("block_number").alias("blockNumber"), _hex("log_index").alias("logIndex"), _hex("transaction_index").alias("transactionIndex"), F.lit(None).cast("string").alias("transactionHash"), F.concat(F.lit("0xA"), F.col("address")).alias("address"), F.col("data_size").cast("string").alias("data"), F.array("topic0", "topic1").alias("topics"))
    logs = lake.logs().groupBy("block_number", "transaction_index").agg(F.collect_list(log).alias("logs"))
    receipt = F.struct(F.when(F.col("status") == "P", "0x0").otherwise("0x1").alias("status"), F.lit("0x5208").alias("gasUsed"), "logs")
    tx = F.struct(_hex("transaction_index").alias("transactionIndex"), _hex("nonce").alias("nonce"), _hex("from").alias("from"), F.col("type").alias("input"), receipt.alias("receipt_"))
    txs, logs = lake.transactions(), logs.select(F.col("block_number").alias("_n"), F.col("transaction_index").alias("_i"), "logs")
    rows = txs.join(logs, (txs["transaction_index"] == logs["_i"]) & (txs["block_number"] - logs["_n"] == 0), "left")  # met by their key alone, as logs are dealt by it
    return rows.groupBy("block_number", F.floor(F.col("transaction_index") / LINE_KEYS)).agg(F.collect_list(tx).alias("transactions")).select(_hex("block_number").alias("number"), _hex("block_number").alias("hash"), "transactions")


def _ingested(lake, table: str):
    """A table, from the JSON text of the blocks: as no other is wanted, parsed blocks are not stored, and of a rule's table only its members are parsed."""
    raw, rule = RAW["eth"], rule_of(RAW["eth"], table)
    own = replace(raw, tables=(rule,), more=None, more_schema="") if rule else raw
    lines = _raw_orders(lake).select(F.to_json(F.struct("number", "hash", "transactions")).alias("value"))
    return tables_of_chain(own, lines.select(F.inline(F.array(F.from_json("value", raw_schema(own))))), keep=False)[table]  # parsed once, not once a member


@query("SELECT block_number, transaction_index, '0x' || lower(to_hex(\"from\")) AS \"from\", nonce, CASE WHEN length(type) >= 10 THEN substr(type, 1, 10) END AS sighash, CASE status WHEN 'P' THEN 0 ELSE 1 END AS status, '0x5208' AS gas_used FROM txs", "txs")
def ingest_transactions(lake):
    return _ingested(lake, "transactions").select(F.col("block_number").cast("long"), F.col("transaction_index").cast("long"), "from", "nonce", "sighash", F.col("status").cast("int"), "gas_used")


@query("SELECT block_number, transaction_index, log_index, '0xa' || address AS address, CAST(data_size AS VARCHAR) AS data, topic0, topic1 FROM logs", "logs")
def ingest_logs(lake):
    return _ingested(lake, "logs").select(F.col("block_number").cast("long"), F.col("transaction_index").cast("long"), F.col("log_index").cast("long"), "address", "data", "topic0", "topic1")


@query("""SELECT block_number, extrinsic_index, array_to_string(address, '.') AS address, name, '{"n":' || len(address) || '}' AS args, CASE WHEN name = 'region' THEN CAST(extrinsic_index AS VARCHAR) END AS _ethereum_transact_to FROM calls""", "calls")
def ingest_calls(lake):
    """Calls of a tagged chain, with arguments as JSON and a hidden index column."""
    call = F.struct(F.col("extrinsic_index").alias("extrinsicIndex"), "address", "name", F.struct(F.size("address").alias("n")).alias("args"), F.when(F.col("name") == "region", F.col("extrinsic_index").cast("string")).alias("_ethereumTransactTo"))
    blocks = lake.calls().groupBy("block_number").agg(F.collect_list(call).alias("calls")).select(F.struct(F.col("block_number").alias("height")).alias("header"), "calls")
    lines = blocks.select(F.to_json(F.struct("header", "calls")).alias("value"))
    raw = RAW["substrate"]
    found = tables_of_chain(raw, lines.select(F.from_json("value", raw_schema(raw)).alias("b")).select("b.*"))["calls"]
    return found.select(F.col("block_number").cast("long"), F.col("extrinsic_index").cast("long"), text("address").alias("address"), "name", "args", "_ethereum_transact_to")


@query("""SELECT id, '0x' || substr(h, 1, 2) AS d1, '0x' || substr(h, 1, 4) AS d2, '0x' || substr(h, 1, 8) AS d4, '0x' || substr(h, 1, 16) AS d8 FROM (
SELECT id, CASE WHEN length(x) % 2 = 1 THEN '0' ELSE '' END || x AS h FROM (SELECT o_orderkey AS id, lower(to_hex(list_reduce(list_transform(list_prepend('1', string_split('zq' || translate(CAST(o_orderkey * 7919 + o_custkey AS VARCHAR), '0', 'X'), '')), lambda c: CAST(instr('123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz', c) - 1 AS HUGEINT)), lambda a, b: a * 58 + b))) AS x FROM orders))""")
def discriminators(lake):
    data = F.concat(F.lit("zq"), F.translate((F.col("o_orderkey") * 7919 + F.col("o_custkey")).cast("string"), "0", "X"))
    return I.discriminators(lake.table("orders").select(F.col("o_orderkey").alias("id"), data.alias("data"))).drop("data")


_ROLL = """WITH RECURSIVE r AS (SELECT *, row_number() OVER (ORDER BY number) AS i FROM ({rows})), g AS (
SELECT i, number, size, CAST(0 AS BIGINT) AS page, size AS total FROM r WHERE i = 1
UNION ALL SELECT r.i, r.number, r.size, CASE WHEN g.total > {limit} THEN g.page + 1 ELSE g.page END, CASE WHEN g.total > {limit} THEN r.size ELSE g.total + r.size END FROM g JOIN r ON r.i = g.i + 1)"""
_HEIGHTS = "SELECT datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS number, CAST(sum(o_orderkey % 1000) AS BIGINT) AS size FROM orders GROUP BY 1"


def _height_sizes(lake):
    return lake.transactions().groupBy("block_number").agg(F.sum(F.col("transaction_index") % 1000).cast("long").alias("size"))


@query(_ROLL.format(rows=_HEIGHTS, limit=20_000) + " SELECT number AS block_number, page AS chunk FROM g")
def assign_chunks_exact(lake):
    """The greedy roll over all heights, exact without a task that holds them all."""
    return B.assign_chunks(_height_sizes(lake), 20_000, exact=True, bucket=200).select("block_number", "chunk")


@query(_ROLL.format(rows=_HEIGHTS, limit=20_000) + " SELECT page, min(number) AS first_block, max(number) AS last_block, count(*) AS blocks, '[' || string_agg(CAST(size AS VARCHAR), ',' ORDER BY number) || ']' AS body FROM g GROUP BY 1")
def result_pages(lake):
    values = _height_sizes(lake).select("block_number", F.col("size").cast("string").alias("value"), "size")
    return sinks.result_pages(values, 20_000, size="size").drop("sha3")


# streams, as batches


@query("SELECT DISTINCT l_orderkey AS chain, l_linenumber AS number FROM lineitem")
def dedupe_blocks(lake):
    return S.dedupe_blocks(lake.table("lineitem").select(F.col("l_orderkey").alias("chain"), F.col("l_linenumber").alias("number")))


@query("SELECT event_id, event_type FROM (SELECT *, max(event_id) OVER (PARTITION BY event_type) AS tip FROM events) WHERE event_id <= tip - 10")
def finalized_blocks(lake):
    return S.finalized(lake.table("events").withColumnRenamed("event_id", "number"), 10, "event_type").select(F.col("number").alias("event_id"), "event_type")


def _streamed(lake, path: str, rows: DataFrame, parts: int = 1) -> tuple[DataFrame, str]:
    """A table as a stream of files in the shared folder: written in as many parts by height, one after the other, then read as they came."""
    source = f"{shared_dir(lake.spark)}/{path}-{uuid.uuid4().hex}"
    stretch = F.floor(F.col("number") * parts / F.lit((rows.agg(F.max("number")).first()[0] or 0) + 1)) if parts > 1 else F.lit(0)
    for k in range(parts):
        (rows.where(stretch == k).coalesce(1) if parts > 1 else rows).write.mode("append").parquet(source)
    return lake.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source), source


def _event_blocks(lake) -> DataFrame:
    """Events as blocks of the chain of their type; every third one comes twice."""
    e = lake.table("events").select(F.col("event_type").alias("chain"), F.col("event_id").cast("long").alias("number"), F.col("event_id").cast("string").alias("hash"))
    return e.unionAll(e.where("number % 3 = 0"))


@query("SELECT event_type AS chain, event_id AS number, CAST(event_id AS VARCHAR) AS hash FROM (SELECT *, max(event_id) OVER (PARTITION BY event_type) AS tip FROM events) WHERE event_id <= tip - 10")
def finalized_stream(lake):
    """Events once they lie ten below the tip of their type, from a stream in several batches that brings some twice."""
    stream, source = _streamed(lake, "finality", _event_blocks(lake), parts=4)
    return S.run_to_end(S.finalized_stream(stream, 10), f"{source}-out", f"{source}-state")


@query("SELECT event_type AS chain, event_id AS number, expected, actual FROM (SELECT event_type, event_id, CAST(before AS VARCHAR) AS expected, CASE WHEN event_id % 50 = 0 THEN 'lost' ELSE CAST(before AS VARCHAR) END AS actual FROM (SELECT *, lag(n) OVER (PARTITION BY event_type ORDER BY event_id) AS before FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events))) WHERE expected IS NOT NULL AND actual <> expected")
def continuity_stream(lake):
    """Events chained by their place among those of their type, every fiftieth with another parent, in several batches out of order."""
    nth = F.row_number().over(Window.partitionBy("event_type").orderBy("event_id"))
    e = lake.table("events").withColumn("n", nth.cast("long"))
    parent = F.when(F.col("event_id") % 50 == 0, "lost").otherwise((F.col("n") - 1).cast("string"))
    rows = e.select(F.col("event_type").alias("chain"), F.col("n").alias("number"), F.col("n").cast("string").alias("hash"), parent.alias("parent_hash"), F.col("event_id").cast("long").alias("event_id"))
    stream, source = _streamed(lake, "continuity", rows.drop("event_id").repartition(4, F.col("number") % 4))
    seed = {r.chain: (0, "0") for r in rows.select("chain").distinct().collect()}  # a row a chain
    found = S.run_to_end(S.continuity_stream(stream, seed=seed, patience=1 << 40), f"{source}-out", f"{source}-state").where("number > 1")
    return found.join(rows.select("chain", "number", "event_id"), ["chain", "number"]).select("chain", F.col("event_id").alias("number"), "expected", "actual")


@query("""SELECT event_type AS chain, strftime(w, '%Y-%m-%d %H:%M:%S') AS start, CAST(round((max(event_id) - min(event_id)) / 600.0 * 1000) AS BIGINT) AS milli_rate FROM (
SELECT event_type, event_id, unnest([time_bucket(INTERVAL 300 SECONDS, ts), time_bucket(INTERVAL 300 SECONDS, ts) - INTERVAL 300 SECONDS]) AS w FROM events) GROUP BY 1, w""")
def progress_rate(lake):
    rate = S.progress_rate(lake.table("events"), "event_id", "ts", "event_type", "600 seconds", "300 seconds", 600)
    return rate.select("chain", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), F.round(F.col("rate") * 1000).cast("long").alias("milli_rate"))


@query("""SELECT t.event_type AS chain, t.number, least(t.k, 11) AS samples, CAST(round(coalesce((t.number - f.number) / nullif(t.sec - f.sec, 0), 0) * 1000000) AS BIGINT) AS micro_rate FROM last t JOIN heights f ON f.event_type = t.event_type AND f.k = greatest(t.k - 10, 1)""", "last")
def sample_rate(lake):
    """Events a second of each type over its last ten intervals of over an hour, from a stream in four batches."""
    nth = F.row_number().over(Window.partitionBy("event_type").orderBy("ts", "event_id"))
    rows = lake.table("events").select(F.col("event_type").alias("chain"), nth.cast("long").alias("number"), F.col("ts").cast("timestamp").alias("ts"))
    stream, source = _streamed(lake, "samples", rows, parts=4)
    out = S.run_to_end(S.sample_rate_stream(stream, "number", "ts", "chain", samples=10, gap=3600), f"{source}-out", f"{source}-state")
    last = out.groupBy("chain").agg(F.max_by(F.struct("number", "samples", "rate"), "number").alias("r"))
    return last.select("chain", "r.number", F.col("r.samples").cast("long").alias("samples"), F.round(F.col("r.rate") * 1_000_000).cast("long").alias("micro_rate"))


@query("SELECT event_type AS chain, max(event_id) AS latest, CAST(max(value * 1000) AS BIGINT) AS worst FROM events GROUP BY 1")
def delivery_delay(lake):
    e = lake.table("events").withColumn("seen", F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.round(F.col("value") * 1_000_000).cast("long")))
    out = S.delivery_delay(e, "event_id", "ts", "seen", "event_type")
    return out.select("chain", "latest", F.round(F.col("worst_seconds") * 1000).cast("long").alias("worst"))


def flagship_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["flagship"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
