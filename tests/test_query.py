"""Requests over a small hand-made lake."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from blocklake.plans.chains import MODELS
from blocklake.plans.query import InvalidQuery, query, to_json, validate

EVM = MODELS["eth"]


@pytest.fixture(scope="module")
def tables(spark):
    data = {
        "blocks": ([(n, f"0xh{n}", f"0xh{n - 1}", 1000 + n, 7) for n in range(1, 6)], "number long, hash string, parent_hash string, timestamp long, extra_data_size long"),
        "transactions": ([(n, t, f"0x{n}{t}", "alice" if t else "bob", "carol", n * 10 + t, 1, 50) for n in range(1, 6) for t in range(2)], "block_number long, transaction_index int, hash string, `from` string, `to` string, nonce long, chain_id long, input_size long"),
        "logs": ([(2, 0, 0, "token", "T", None, None, None, 100), (2, 1, 1, "token", "S", "x", None, None, 100), (4, 1, 0, "other", "T", "y", "z", None, 10)], "block_number long, transaction_index int, log_index int, address string, topic0 string, topic1 string, topic2 string, topic3 string, data_size long"),
        "traces": (
            [(2, 0, [], "call", "bob", "carol", None, None), (2, 0, [0], "create", None, None, "fac", "new"), (2, 0, [0, 0], "call", "new", "lib", None, None), (2, 0, [1], "call", "carol", "lib", None, None), (4, 1, [], "call", "x", "y", None, None)],
            "block_number long, transaction_index int, trace_address array<int>, type string, call_from string, call_to string, create_from string, create_result_address string",
        ),
    }
    frames = {k: spark.createDataFrame(*v) for k, v in data.items()}
    return lambda name: frames[name]


def run(tables, request, **more):
    return {r.block_number: json.loads(r.value) for r in to_json(query(EVM, tables, request, **more)).collect()}


def test_logs_with_their_transactions(tables):
    got = run(tables, {"fromBlock": 1, "toBlock": 5, "logs": [{"address": ["token"], "topic0": ["T"], "transaction": True}, {"topic1": ["y"]}], "fields": {"log": {"topics": True}, "transaction": {"from": True, "chainId": True}, "block": {"timestamp": True}}})
    assert sorted(got) == [1, 2, 4, 5]  # the ends of the range are always there
    assert got[1]["logs"] == [] and got[1]["transactions"] == [] and got[1]["header"] == {"number": 1, "hash": "0xh1", "parentHash": "0xh0", "timestamp": 1001}
    assert got[2]["logs"] == [{"logIndex": 0, "transactionIndex": 0, "topics": ["T"]}]
    assert got[2]["transactions"] == [{"transactionIndex": 0, "from": "bob", "chainId": 1}]
    assert got[4]["logs"][0]["topics"] == ["T", "y", "z"] and got[4]["transactions"] == []


def test_trace_relations(tables):
    request = lambda flag: {"fromBlock": 1, "traces": [{"type": ["create"], flag: True}], "fields": {"trace": {"callTo": True, "createResultAddress": True}}}
    sub = run(tables, request("subtraces"))[2]["traces"]
    assert [t["traceAddress"] for t in sub] == [[0], [0, 0]]
    # each row has what was asked for of its own type; a result without members is left out, an action is not
    assert sub[0]["result"] == {"address": "new"} and "action" not in sub[0] and sub[1]["action"] == {"to": "lib"} and "result" not in sub[1]
    assert [t["traceAddress"] for t in run(tables, request("parents"))[2]["traces"]] == [[], [0]]
    logs = run(tables, {"fromBlock": 1, "logs": [{"topic0": ["T"], "address": ["token"], "transactionTraces": True}]})
    assert len(logs[2]["traces"]) == 4


def test_traces_by_type(spark):
    kind = "block_number long, transaction_index int, trace_address array<int>, type string, error string, call_from string, call_to string, call_result_output string, create_from string, create_result_address string, suicide_address string"
    rows = [(1, 0, [], "call", None, "a", None, "0x1", None, None, None), (1, 0, [0], "call", "bad", None, None, None, None, None, None), (1, 0, [1], "create", None, None, None, None, "c", "d", None), (1, 0, [2], "suicide", None, None, None, None, None, None, "s"), (1, 0, [3], "reward", None, *[None] * 6)]
    frames = {"traces": spark.createDataFrame(rows, kind), "blocks": spark.createDataFrame([(1, "h", "p")], "number long, hash string, parent_hash string")}
    run_ = lambda *fields: [{k: v for k, v in t.items() if k not in ("transactionIndex", "traceAddress")} for t in json.loads(to_json(query(EVM, frames.get, {"traces": [{}], "fields": {"trace": dict.fromkeys(fields, True)}})).first().value)["traces"]]
    assert run_("error", "callFrom", "callTo", "callResultOutput") == [
        {"type": "call", "error": None, "action": {"from": "a"}, "result": {"output": "0x1"}}, {"type": "call", "error": "bad", "action": {}}, {"type": "create", "error": None}, {"type": "suicide", "error": None}, {"type": "reward", "error": None},
    ]
    assert run_("createResultAddress", "suicideAddress") == [{"type": "call"}, {"type": "call"}, {"type": "create", "result": {"address": "d"}}, {"type": "suicide", "action": {"address": "s"}}, {"type": "reward"}]
    assert run_("error")[1] == {"type": "call", "error": "bad"}


def test_ends_of_each_chunk(tables, spark):
    chunks = spark.createDataFrame([(1, 2), (3, 4), (5, 9)], "first_block long, last_block long")
    request = {"fromBlock": 2, "toBlock": 5, "logs": [{"address": []}]}
    assert sorted(run(tables, request, chunks=chunks)) == [2, 3, 4, 5]
    assert sorted(run(tables, request, chunk=lambda n: F.floor((n - 1) / 2))) == [2, 3, 4, 5]
    assert sorted(run(tables, {**request, "fromBlock": 3}, chunks=spark.createDataFrame([(0, 50)], "first_block long, last_block long"))) == [3, 5]
    # a budget counts within each chunk: the second block of a chunk goes only if the first is over it
    got = run(tables, {"fromBlock": 1, "transactions": [{}]}, limit=100, chunks=chunks)
    assert sorted(got) == [1, 3, 5]
    assert sorted(run(tables, {"fromBlock": 1, "transactions": [{}]}, limit=200, chunks=chunks)) == [1, 2, 3, 4, 5]


def test_structs_of_fuel_and_starknet(spark):
    tx = spark.sql("SELECT 1L AS block_number, 0 AS index, named_struct('tip', 7L, 'witness_limit', null, 'maturity', 3, 'max_fee', 9L) AS policies, named_struct('utxo_id', 'u', 'balance_root', 'b', 'state_root', 's', 'tx_pointer', 't', 'contract_id', 'c') AS input_contract, cast(null as struct<input_index:int,balance_root:string,state_root:string>) AS output_contract")
    frames = {"transactions": tx, "blocks": spark.createDataFrame([(1, "h", 5)], "number long, hash string, height long")}
    asked = {"transactions": [{}], "fields": {"transaction": dict.fromkeys(("policies", "inputContract", "outputContract"), True)}}
    got = json.loads(to_json(query(MODELS["fuel"], frames.get, asked)).first().value)["transactions"][0]
    assert got["policies"] == {"tip": "7", "witnessLimit": None, "maturity": 3, "maxFee": "9"} and got["outputContract"] is None
    assert got["inputContract"] == {"utxoId": "u", "balanceRoot": "b", "stateRoot": "s", "txPointer": "t", "contractId": "c"}
    tx = spark.sql("SELECT 1L AS block_number, 0 AS transaction_index, '0x1' AS resource_bounds_l1_gas_max_amount, '0x2' AS resource_bounds_l1_gas_max_price_per_unit, '0x3' AS resource_bounds_l2_gas_max_amount, cast(null as string) AS resource_bounds_l2_gas_max_price_per_unit, '0x5' AS actual_fee_amount, 'WEI' AS actual_fee_unit")
    frames = {"transactions": tx, "blocks": spark.createDataFrame([(1, "h", "p")], "number long, hash string, parent_hash string")}
    asked = {"transactions": [{}], "fields": {"transaction": {"resourceBounds": True, "actualFee": True}}}
    got = json.loads(to_json(query(MODELS["starknet"], frames.get, asked, limit=10**6)).first().value)["transactions"][0]
    assert got["resourceBounds"] == {"l1GasMaxAmount": "0x1", "l1GasMaxPricePerUnit": "0x2", "l2GasMaxAmount": "0x3", "l2GasMaxPricePerUnit": None} and got["actualFee"] == {"amount": "0x5", "unit": "WEI"}


def test_children_bounds_and_all_blocks(tables):
    got = run(tables, {"fromBlock": 1, "includeAllBlocks": True, "transactions": [{"firstNonce": 20, "lastNonce": 21, "logs": True}]})
    assert sorted(got) == [1, 2, 3, 4, 5] and [x["logIndex"] for x in got[2]["logs"]] == [0, 1] and len(got[2]["transactions"]) == 2 and got[3]["transactions"] == []
    none = run(tables, {"fromBlock": 1, "logs": [{"address": []}]})
    assert sorted(none) == [1, 5] and none[1]["logs"] == []


def test_budget_keeps_the_block_that_crosses(tables):
    got = run(tables, {"fromBlock": 1, "transactions": [{}]}, limit=300)
    assert sorted(got) == [1, 2]  # two transactions of 32 and a header of 96 a block: 160, 320


@pytest.mark.parametrize("request_", [{"fromBlock": 3, "toBlock": 2}, {"logs": [{"nope": []}]}, {"fields": {"log": {"nope": True}}}, {"nope": []}, {"type": "btc"}, {"logs": [{}] * 101}, {"fromBlock": -1}, {"logs": [{"address": "x"}]}, {"logs": [{"transaction": 1}]}])
def test_bad_requests(request_):
    with pytest.raises(InvalidQuery):
        validate(EVM, request_)


def test_models_are_whole():
    assert sum(len(m.scans) for m in MODELS.values()) == 34 and sum(len(m.items) for m in MODELS.values()) == 26
    for m in MODELS.values():
        for item in m.items:
            assert item.table in m.tables and item.entity in m.fields and set(item.mandatory) <= set(m.fields[item.entity])
            assert all(r.scan in m.scans for r in item.relations) and all(s in m.scans for s in item.scans)
            for r in item.relations:
                validate(m, {r.scan: [{r.flag: True}]})


def test_substrate_stack_and_events(spark):
    events = spark.createDataFrame([(1, 0, 0, [0, 1], "EVM.Log", "0xa"), (1, 1, 0, None, "System.Ok", None), (1, 2, 0, [0], "B", None)], "block_number long, `index` int, extrinsic_index int, call_address array<int>, name string, _evm_log_address string")
    for c in ("topic0", "topic1", "topic2", "topic3"):
        events = events.selectExpr("*", f"cast(null as string) as _evm_log_{c}")
    calls = spark.createDataFrame([(1, 0, [], "batch"), (1, 0, [0], "inner"), (1, 0, [0, 1], "evm"), (1, 0, [1], "other")], "block_number long, extrinsic_index int, address array<int>, name string")
    blocks = spark.createDataFrame([(1, "h", "p")], "number long, hash string, parent_hash string")
    frames = {"events": events, "calls": calls, "blocks": blocks, "extrinsics": spark.createDataFrame([(1, 0)], "block_number long, `index` int")}
    got = query(MODELS["substrate"], frames.get, {"evmLogs": [{"address": ["0xa"], "stack": True, "extrinsic": True}], "calls": [{"name": ["inner"], "events": True, "siblings": True}]}).first()
    assert [list(c.address) for c in got.calls] == [[], [0], [0, 1], [1]] and [e["index"] for e in got.events] == [0, 2] and len(got.extrinsics) == 1
