"""Operators against brute force on random input, and small hand-made cases."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from blocklake.functions import codecs
from blocklake.functions import project as P
from blocklake.operators import audit, budget, ingest, predicates, ranges, relations
from blocklake.sources import layout, sinks

NODE = "block_number long, tx long, address array<int>"


def forest(seed: int, n: int = 60) -> list[tuple]:
    r = random.Random(seed)
    return [(r.randrange(2), r.randrange(3), [r.randrange(2) for _ in range(r.randrange(5))]) for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_tree_relations_against_brute_force(spark, seed):
    items, scan = forest(seed), [*forest(seed + 10, 8), (0, 0, None)]
    i, s = spark.createDataFrame([(*x, k) for k, x in enumerate(items)], NODE + ", k int"), spark.createDataFrame(scan, NODE)
    on, at = [("tx", "tx")], ("address", "address")
    prefix = lambda a, b: b is not None and a is not None and b[: len(a)] == a
    tests = {
        "descendants": (relations.descendants(i, s, on, at), lambda a, b: prefix(b, a) and len(a) > len(b)),
        "descendants_or_self": (relations.descendants(i, s, on, at, True), lambda a, b: prefix(b, a)),
        "subtree": (relations.subtree(i, s, on, at), lambda a, b: prefix(b, a) and len(a) > len(b)),
        "ancestors": (relations.ancestors(i, s, on, at), lambda a, b: prefix(a, b) and len(a) < len(b)),
        "ancestors_or_self": (relations.ancestors(i, s, on, at, True), prefix),
        "siblings": (relations.siblings(i, s, on, at), lambda a, b: b is not None and len(a) == len(b)),
        "same_parent": (relations.siblings(i, s, on, at, same_parent=True), lambda a, b: b is not None and len(a) == len(b) and a[:-1] == b[:-1]),
        "at": (relations.join_at(i, s, on, at), lambda a, b: a == b),
    }
    for name, (df, test) in tests.items():
        want = sorted(k for k, (b, t, a) in enumerate(items) if any((b, t) == x[:2] and test(a, x[2]) for x in scan))
        assert sorted(r.k for r in df.collect()) == want, name
    assert "NestedLoop" not in relations.descendants(i, s, on, at)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(2))
def test_ranges_against_sets(spark, seed):
    r = random.Random(seed)
    make = lambda n: [(d, b, b + r.randrange(12)) for d in "xy" for b in (r.randrange(120) for _ in range(n))]
    a, b = make(9), make(6)
    heights = lambda rows: {(d, h) for d, x, y in rows for h in range(x, y + 1)}
    df = lambda rows: spark.createDataFrame(rows, "dataset string, beg long, end long")
    for out, want in ((ranges.merge_ranges(df(a)), heights(a)), (ranges.subtract_ranges(df(a), df(b)), heights(a) - heights(b)), (ranges.intersect_ranges(df(a), df(b), 16), heights(a) & heights(b))):
        rows = [(x.dataset, x.beg, x.end) for x in out.collect()]
        assert heights(rows) == want and sum(e - s + 1 for _, s, e in rows) == len(want)
        assert not any((d, e + 1) in want for d, _, e in rows)
    assert {x.kind for x in ranges.coverage(df(a), df(b)).collect()} <= {"new", "deletable", "needed"}


def test_greedy_pages_and_chunks(spark):
    r = random.Random(1)
    rows = [(c, n, r.randrange(1, 40)) for c in range(3) for n in range(30)]
    got = {(x.chunk, x.block_number): x.page for x in budget.paginate(spark.createDataFrame(rows, "chunk long, block_number long, size long"), 60).collect()}
    for c in range(3):
        page = total = 0
        for _, n, size in (x for x in rows if x[0] == c):
            assert got[c, n] == page
            total += size
            if total > 60:
                page, total = page + 1, 0


def test_empty_list_matches_nothing_and_none_everything(spark):
    df = spark.range(5).withColumnRenamed("id", "block_number").withColumn("k", F.col("block_number"))
    assert predicates.scan(df, [predicates.field_in("k", [])], ["k"]).count() == 0
    assert predicates.scan(df, [predicates.field_in("k", None)], ["k"]).count() == 5
    assert predicates.scan(df, [], ["k"]).count() == 0


def test_case_rules():
    for camel, snake in (("parentHash", "parent_hash"), ("sha3Uncles", "sha3_uncles"), ("cancelUnfreezeV2Amount", "cancel_unfreeze_v2_amount"), ("l1BaseFeeScalar", "l1_base_fee_scalar"), ("a15", "a15")):
        assert P.snake(camel) == snake
    assert P.camel("parent_hash") == "parentHash"
    assert P.selected_fields(("a", "b"), {"c": True, "a": True, "d": False}) == ["a", "b", "c"]
    assert P.without_prefix("contractCreatedContract", ("contract", "contractCreated")) == "createdContract"


def test_projection_functions(spark):
    row = spark.sql("SELECT 1 AS a, cast(null as string) AS b, 9007199254740993L AS big, 5L AS small, array('x') AS rest, '{\"q\":[1]}' AS j").select(
        P.json_object(F.struct("a", "b")).alias("kept"), P.json_object(F.struct("a", "b"), False).alias("dropped"), F.to_json(F.struct(P.safe_integer(F.col("big")).alias("v"))).alias("big"), F.to_json(F.struct(P.safe_integer(F.col("small")).alias("v"))).alias("small"),
        P.list_with_rest([F.col("b"), F.lit("p")], F.col("rest")).alias("all"), P.list_with_rest([F.lit("p")], F.lit(None).cast("array<string>")).alias("none"), F.to_json(F.struct(P.embedded_json(F.col("j")).alias("j"))).alias("j"), P.byte_size(F.lit("é")).alias("n"),
    ).first()
    assert json.loads(row.kept) == {"a": 1, "b": None} and json.loads(row.dropped) == {"a": 1}
    assert json.loads(row.big) == {"v": "9007199254740993"} and json.loads(row.small) == {"v": 5}
    assert row.all == ["p", "x"] and row.none == ["p"] and json.loads(row.j) == {"j": {"q": [1]}} and row.n == 2


def test_codecs():
    assert [h.hex() for h in codecs.keccak256([b"", b"abc"])] == ["c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470", "4e03657aea45a94fc7d47ba826c8d667c0d1e6e33a64a036ec44f58fa12d6c45"]
    assert codecs.base58_decode(["2NEpo7TZRRrLZSi2U", "11", "", None]) == [b"Hello World!", b"\0\0", b"", None]


def test_hashes_of_all_lengths_at_once():
    """The permutation and its padding against the standard library's SHA3, which differs in one byte of padding."""
    r = random.Random(2)
    values = [r.randbytes(n) for n in [*range(301), 1000, 5000]] + [None, bytes(136), bytes(135)]
    r.shuffle(values)
    assert codecs.keccak256(values, 0x06) == [None if v is None else hashlib.sha3_256(v).digest() for v in values]


def encoded(data):
    n, out = int.from_bytes(data, "big"), ""
    while n:
        n, d = divmod(n, 58)
        out = codecs.BASE58[d] + out
    return "1" * (len(data) - len(data.lstrip(b"\0"))) + out


def test_base58_against_whole_numbers():
    """Leading zeros, all lengths mixed in a batch, texts with signs that are none (null)."""
    r = random.Random(3)
    values = [v for n in range(90) for v in (r.randbytes(n), bytes(n // 2) + r.randbytes(n - n // 2), bytes(n), b"\xff" * n)] + [r.randbytes(700)]
    r.shuffle(values)
    assert codecs.base58_decode([encoded(v) for v in values]) == values
    assert codecs.base58_decode(["0", "I", "l", "O", "é", "1 1", "zz\n", "2", "z" * 20 + "0"]) == [None] * 7 + [b"\1", None]


def test_logs_bloom_has_three_bits_an_entry(spark):
    entry = "0x" + "ab" * 20
    logs = spark.createDataFrame([(1, entry, None, None, None, None)] * 2, "block_number long, address string, topic0 string, topic1 string, topic2 string, topic3 string")
    want = 0
    h = codecs.keccak256([bytes.fromhex(entry[2:])])[0]
    for i in (0, 2, 4):
        want |= 1 << (int.from_bytes(h[i : i + 2], "big") & 2047)
    bloom = audit.logs_bloom(logs).first().bloom
    assert bloom == f"0x{want:0512x}"
    headers = spark.createDataFrame([(1, bloom), (2, "0x" + "0" * 512), (3, bloom)], "number long, logs_bloom string")
    assert [r.block_number for r in audit.audit_logs_bloom(headers, logs).collect()] == [3]


def test_call_frames(spark):
    frame = {"type": "CALL", "from": "a", "to": "b", "calls": [{"type": "STOP"}, {"type": "CREATE", "from": "b"}, {"type": "DELEGATECALL", "to": "c", "calls": [{"type": "SELFDESTRUCT"}]}]}
    rows = ingest.flatten_call_frames(spark.createDataFrame([(1, 0, json.dumps(frame)), (1, 1, None)], "block_number long, transaction_index long, frame string")).collect()
    assert [(list(r.trace_address), r.subtraces, r.type, r.call_type) for r in rows] == [([], 2, "call", "call"), ([0], 0, "create", None), ([1], 1, "call", "delegatecall"), ([1, 0], 0, "suicide", None)]


def test_invocations_count_on(spark):
    trace = {"validate_invocation": {"events": [{}, {}], "calls": [{"events": [{}]}]}, "execute_invocation": {"calls": [{}, {"events": [{}]}]}}
    rows = ingest.unwrap_invocations(spark.createDataFrame([(1, 0, json.dumps(trace))], "block_number long, transaction_index long, trace string")).collect()
    assert [(r.invocation_type, list(r.trace_address), r.n_events, r.first_event) for r in rows] == [("validate", [0], 2, 0), ("validate", [0, 1], 1, 2), ("execute", [2], 0, 3), ("execute", [2, 3], 0, 3), ("execute", [2, 4], 1, 3)]


def test_quantities_of_all_lengths(spark):
    values = [0, 1, 255, (1 << 63) - 1, 0x123456789ABCDEF]
    hexes = spark.createDataFrame([(f"0x{'0' * (i % 3)}{v:x}",) for i, v in enumerate(values)] + [(None,), ("0x" + "0" * 60 + "7",)], "c string")
    assert [r.v for r in hexes.select(ingest.hex_to_int(F.col("c")).alias("v")).collect()] == [*values, None, 7]
    wide = [1 << 63, (1 << 64) - 1, (1 << 64) + 5, (1 << 123) + (1 << 70) + 3, 16**31 - 1]
    big = spark.createDataFrame([(f"0x{v:x}",) for v in wide], "c string")
    assert [int(r.v) for r in big.select(ingest.hex_to_decimal(F.col("c")).alias("v")).collect()] == wide
    for v in (1 << 63, 0x123456789ABCDEF01, 1 << 200):
        with pytest.raises(Exception, match="more than 63 bits"):
            spark.createDataFrame([(f"0x{v:x}",)], "c string").select(ingest.hex_to_int(F.col("c"))).collect()
    with pytest.raises(Exception, match="more than 124 bits"):
        spark.createDataFrame([(f"0x{1 << 255:x}",)], "c string").select(ingest.hex_to_decimal(F.col("c"))).collect()


def test_receipts_and_status_from_traces(spark):
    frame, trace = "struct<type:string,error:string,to:string>", "struct<type:string,error:string,address:string>"
    rows = [("h1", "b1", None, None), ("h2", "b1", None, None), ("h3", "b1", ("INVALID", None, "x"), None), ("h4", "b1", ("CREATE", None, "new"), ("create", None, "other")), ("h5", "b1", ("CREATE2", "bad", "new"), None), ("h6", "b1", None, ("create", None, "made")), ("h7", "b1", None, ("call", "bad", None)), ("h8", "b2", None, None)]
    txs = spark.createDataFrame(rows, f"hash string, block_hash string, frame {frame}, trace {trace}")
    receipts = spark.createDataFrame([("h1", "b1", "0x1", "0xc", "0x5208", "0x2"), ("h2", "b9", "0x1", None, "0x1", None), ("h4", "b9", "0x0", None, "0x1", None)], "transactionHash string, blockHash string, status string, contractAddress string, gasUsed string, type string")
    got = {r.hash: (r.status, r.contract_address, r.gas_used, r.type) for r in ingest.with_receipts(txs, receipts).collect()}
    none = (None, None, None, None)
    assert got == {"h1": (1, "0xc", "0x5208", 2), "h2": none, "h3": (0, None, None, None), "h4": (1, "new", None, None), "h5": (0, None, None, None), "h6": (1, "made", None, None), "h7": (0, None, None, None), "h8": none}


def test_state_diffs(spark):
    kind = "block_number long, transaction_index long, address string, key string, value string"
    pre = [(1, 0, "x", "balance", "1"), (1, 0, "x", "nonce", "2"), (1, 0, "x", "0xs1", "5"), (1, 0, "x", "0xs2", "6")]
    post = [(1, 0, "x", "balance", "3"), (1, 0, "x", "0xs2", "7"), (1, 0, "y", "code", "c")]
    got = {(r.address, r.key): (r.kind, r.prev, r.next) for r in ingest.prestate_diff(spark.createDataFrame(pre, kind), spark.createDataFrame(post, kind)).collect()}
    assert got == {("x", "balance"): ("*", "1", "3"), ("x", "0xs1"): ("-", "5", None), ("x", "0xs2"): ("*", "6", "7"), ("y", "code"): ("+", None, "c")}
    diffs = [("a", '"="'), ("b", '{"+":"0x1"}'), ("c", '{"-":"0x2"}'), ("d", '{"*":{"from":"0x3","to":"0x4"}}')]
    df = spark.createDataFrame([(1, 0, k, "balance", d) for k, d in diffs], "block_number long, transaction_index long, address string, key string, diff string")
    got = {r.address: (r.kind, r.prev, r.next) for r in ingest.parity_state_diff(df).collect()}
    assert got == {"b": ("+", None, "0x1"), "c": ("-", "0x2", None), "d": ("*", "0x3", "0x4")}


def test_rules_discriminators_and_alignment(spark):
    txs = spark.createDataFrame([(1, 0, "h0", None), (1, 1, "h1", "0x7d"), (2, 0, "h2", "0x2")], "block_number long, transaction_index long, hash string, type string")
    rules = [("c", 0, 5, None, "drop_type", "0x7d"), ("c", 0, 5, None, "fill_type", "0x0"), ("c", 2, 2, "h2", "drop", None), ("other", 0, 9, None, "drop", None)]
    got = ingest.apply_rules(txs, spark.createDataFrame(rules, "chain string, from_block long, to_block long, tx_hash string, action string, value string"), "c").collect()
    assert [(r.hash, r.type) for r in got] == [("h0", "0x0")]
    kinds = ingest.RULES
    wide = spark.createDataFrame([(1, i, f"h{i}", None, ingest.ZERO_ADDRESS if i == 3 else "0x1", ingest.ZERO_ADDRESS, None if i % 2 else "0x9", "b1", "b2" if i == 4 else "b1") for i in range(6)], "block_number long, transaction_index long, hash string, type string, `from` string, `to` string, max_priority_fee_per_gas string, block_hash string, receipt_block_hash string")
    run = lambda *rules: [(r.transaction_index, r.type) for r in ingest.apply_rules(wide, spark.createDataFrame([("c", 1, 1, *r) for r in rules], kinds), "c").orderBy("transaction_index").collect()]
    assert run((None, "fill_type_by", "max_priority_fee_per_gas")) == [(i, "0x0" if i % 2 else "0x2") for i in range(6)]
    assert [i for i, _ in run((None, "drop_zero_address", None))] == [0, 1, 2, 4, 5] and [i for i, _ in run((None, "drop_duplicated", None))] == [0, 1, 2, 3, 5]
    assert run((None, "slice", "4"), ("h5", "set_type", "0x5")) == [(4, None), (5, "0x5")] and len(run()) == 6
    assert "Join" not in ingest.apply_rules(wide, spark.createDataFrame([("c", 1, 1, None, "drop", None)], kinds), "c")._jdf.queryExecution().executedPlan().toString()
    d = ingest.discriminators(spark.createDataFrame([("2NEpo7TZRRrLZSi2U",), (None,)], "data string")).collect()
    assert d[0].d1 == "0x48" and d[0].d4 == "0x48656c6c" and d[1].d8 is None
    t = spark.createDataFrame([(1, 0, "a", "b", "1"), (1, 1, "c", "d", "2")], "block_number long, transaction_index int, from string, to string, value string")
    r = spark.createDataFrame([(1, 0, "a", "b", "1"), (1, 1, "z", "z", "9"), (1, 2, "c", "d", "2")], "block_number long, trace_index int, from string, to string, value string")
    assert sorted((x.transaction_index, x.trace_index) for x in ingest.align_traces(t, r).collect()) == [(0, 0), (1, 2)]


def test_flatten_and_logs(spark):
    raw = spark.createDataFrame([(1, [("t0",), ("t1",)], None), (2, [], [("X",)])], "number long, transactions array<struct<hash:string>>, logs_ array<struct<address:string>>")
    out = ingest.flatten_blocks(raw, {"transactions": "transactions"})
    assert [(r.block_number, r.pos, r.hash) for r in out["transactions"].collect()] == [(1, 0, "t0"), (1, 1, "t1")] and out["blocks"].columns == ["number", "logs_"]
    got = raw.select(ingest.choose_logs(F.col("logs_"), F.array(F.array(F.struct(F.lit("R").alias("address"))))).alias("l")).collect()
    assert [[x.address for x in r.l] for r in got] == [["r"], ["x"]]
    tron = spark.sql("SELECT '{\"value\":{\"owner_address\":\"o\",\"data\":\"0123456789\"}}' AS p, 'TriggerSmartContract' AS t")
    row = tron.select(*[c.alias(k) for k, c in ingest.contract_parameters(F.col("p"), F.col("t")).items()]).first()
    assert row._trigger_smart_contract_owner == "o" and row._trigger_smart_contract_sighash == "01234567" and row._transfer_contract_owner is None


def test_lake_layout_round_trip(spark, tmp_path):
    for first, last in ((0, 4), (5, 9)):
        rows = spark.range(first, last + 1).select(F.col("id").alias("block_number"), (F.col("id") * 10).alias("v"))
        rows.write.parquet(f"{tmp_path}/0000000000/{first:010d}-{last:010d}-abc{first}/logs.parquet")
    cat = layout.chunk_catalog(spark, str(tmp_path))
    assert sorted((r.first_block, r.last_block, r.last_hash) for r in cat.collect()) == [(0, 4, "abc0"), (5, 9, "abc5")]
    assert sorted(r.v for r in layout.read_table(spark, str(tmp_path), "logs", 3, 6, ["v"]).collect()) == [30, 40, 50, 60]
    with pytest.raises(layout.MissingData):
        layout.read_table(spark, str(tmp_path), "traces", 3, 6)
    with pytest.raises(layout.MissingData):
        layout.read_table(spark, str(tmp_path), "logs", 3, 6, ["w"])
    with pytest.raises(layout.MissingData):
        layout.read_table(spark, str(tmp_path), "logs", 100)
    blocks = spark.range(6).select(F.col("id").alias("number"), F.floor(F.col("id") / 3).alias("chunk"))
    sinks.write_raw(blocks, f"{tmp_path}/raw", "chunk")
    assert sorted(r.number for r in sinks.read_raw_blocks(spark, f"{tmp_path}/raw", "number long", 2, 4).collect()) == [2, 3, 4]
    wide = spark.range(40).select(F.col("id").alias("number"), F.repeat(F.lit("x"), 60_000).alias("data"))
    sinks.write_raw(wide, f"{tmp_path}/by_size", chunk_mb=1)
    assert len(list((tmp_path / "by_size").glob("chunk=*"))) == 3 and sinks.read_raw_blocks(spark, f"{tmp_path}/by_size", "number long").count() == 40


def test_only_the_tops_of_a_range_are_listed(spark, tmp_path):
    chunks = [(0, 0, 4), (0, 5, 9), (10, 10, 14), (20, 20, 29)]
    table = spark.range(30).select(F.col("id").alias("number"), F.when(F.col("id") < 20, F.floor(F.col("id") / 5)).otherwise(4).alias("chunk"))
    frame = spark.createDataFrame([(f // 5, t, f, e, f"h{e}") for t, f, e in chunks], "chunk long, top long, first_block long, last_block long, last_hash string")
    logs = table.where("number between 3 and 12").select(F.col("number").alias("block_number"), "chunk")
    sinks.write_lake({"blocks": table, "logs": logs}, {}, frame, str(tmp_path))
    assert layout.tops_of(spark, str(tmp_path), 12, 25) == ["0000000010", "0000000020"] and layout.tops_of(spark, str(tmp_path), None, 3) == ["0000000000"] and len(layout.tops_of(spark, str(tmp_path))) == 3
    assert sorted(r.number for r in layout.read_table(spark, str(tmp_path), "blocks", 8, 21).collect()) == [8, 9, *range(10, 15), 20, 21]
    assert sorted(r.block_number for r in layout.read_table(spark, str(tmp_path), "logs", 4, 25).collect()) == list(range(4, 13))
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_top_folders_roll(spark):
    chunks = spark.createDataFrame([("a", 10 * i, 10 * i + 9) for i in range(7)], "dataset string, first_block long, last_block long")
    assert [r.top for r in budget.assign_tops(chunks, 3).orderBy("first_block").collect()] == [0, 0, 0, 30, 30, 30, 60]
    assert [r.top for r in budget.assign_tops(chunks, 3, last=69).orderBy("first_block").collect()] == [0, 0, 0, 30, 30, 30, 30]


@pytest.mark.parametrize("seed", range(3))
def test_exact_roll_is_the_fold(spark, seed):
    """Random sizes over many buckets: zeros, nulls, blocks beyond the limit, gaps between heights."""
    r = random.Random(seed)
    heights = sorted(r.sample(range(3000), 400))
    rows = [(n, r.choice([0, 0, 1, 5, 30, 99, 100, 101, 700, None])) for n in heights]
    want, total, at = {}, 0, 0
    for n, size in rows:
        want[n] = at
        total += size or 0
        if total > 100:
            total, at = 0, at + 1
    table = spark.createDataFrame(r.sample(rows, len(rows)), "block_number long, size long").withColumn("_mine", F.lit(1))
    got = budget.roll(table, 100, bucket=50)
    assert got.columns == ["block_number", "size", "_mine", "chunk"] and {x.block_number: x.chunk for x in got.collect()} == want
    assert budget.roll(table.limit(0), 100).count() == 0


def test_result_pages(spark, tmp_path):
    values = [(n, json.dumps({"n": n, "é": "x" * (n % 40)})) for n in range(120)]
    pages = sinks.result_pages(spark.createDataFrame(values[::-1], "block_number long, value string"), 300)
    got = pages.orderBy("page").collect()
    assert [b for p in got for b in json.loads(p.body)] == [json.loads(v) for _, v in values] and [p.page for p in got] == list(range(len(got)))
    for p, after in zip(got, [*got[1:], None], strict=True):
        assert p.sha3 == hashlib.sha3_256(p.body.encode()).hexdigest() and p.blocks == p.last_block - p.first_block + 1 and (after is None or after.first_block == p.last_block + 1)
        assert after is None or len(p.body.encode()) > 300
    sinks.write_pages(pages, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out" / "bodies")).count() == len(got) == spark.read.parquet(str(tmp_path / "out" / "pages")).count()
