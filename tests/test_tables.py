"""Raw blocks of each chain to tables, to files of a lake, and back by a request."""

import json
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from blocklake.functions import project as P
from blocklake.functions.codecs import BASE58
from blocklake.plans.chains import MODELS
from blocklake.plans.chains.raw import RAW
from blocklake.plans.query import next_page, query, to_json
from blocklake.plans.tables import ingest, raw_schema
from blocklake.sources import sinks
from blocklake.sources.layout import read_table

H = lambda n: f"0x{n:064x}"

EVM = [
    {
        "number": hex(100 + k), "hash": H(k), "parentHash": H(k - 1 if k else 99), "size": "0x10", "timestamp": "0x5f5e100", "extraData": "0xabcd", "logsBloom": "0x0", "miner": "0xm", "gasUsed": "0x5",
        "transactions": [
            {
                "blockNumber": hex(100 + k), "transactionIndex": "0x0", "hash": H(10 + k), "from": "0xa", "to": "0xb", "input": "0x12345678ff", "nonce": "0x7", "value": "0xffffffffffffffffffff", "gas": "0x1", "chainId": "0x1", "yParity": "0x1",
                "receipt_": {"status": "0x1", "gasUsed": "0x2", "cumulativeGasUsed": "0x3", "type": "0x2", "logs": [{"blockNumber": hex(100 + k), "logIndex": "0x0", "transactionIndex": "0x0", "transactionHash": H(10 + k), "address": "0xABC", "data": "0x00", "topics": ["0xt0", "0xt1"]}]},
                "debugFrame_": {"result": {"type": "CALL", "from": "0xa", "to": "0xb", "input": "0x12345678ff", "gasUsed": "0x9", "output": "0x1", "calls": [{"type": "CREATE2", "from": "0xb", "to": "0xnew", "input": "0xinit", "output": "0xcode", "error": "oops", "revertReason": "why"}, {"type": "SELFDESTRUCT", "from": "0xb", "to": "0xheir", "value": "0x5"}]}},
                "debugStateDiff_": {"result": {"pre": {"0xa": {"balance": "0x5", "nonce": "0x1", "storage": {"0xs1": "0x1", "0xs2": "0x2"}}}, "post": {"0xa": {"balance": "0x4", "storage": {"0xs1": "0x9"}}, "0xc": {"code": "0xcc"}}}},
            },
            {
                "blockNumber": hex(100 + k), "transactionIndex": "0x1", "hash": H(20 + k), "from": "0xb", "input": "0x", "nonce": "0x8", "value": "0x0", "gas": "0x1",
                "traceReplay_": {
                    "trace": [
                        {"traceAddress": [], "subtraces": 1, "type": "create", "action": {"from": "0xb", "value": "0x0", "gas": "0x1", "init": "0xi"}, "result": {"gasUsed": "0x1", "code": "0xc", "address": "0xmade"}},
                        {"traceAddress": [0], "subtraces": 0, "type": "call", "error": "bad", "action": {"from": "0xb", "to": "0xz", "value": "0x0", "gas": "0x1", "input": "0xaabbccdd", "callType": "staticcall"}},
                    ],
                    "stateDiff": {"0xd": {"balance": {"*": {"from": "0x1", "to": "0x2"}}, "code": "=", "nonce": {"+": "0x1"}, "storage": {"0xs": {"-": "0x3"}}}},
                },
            },
        ],
    }
    for k in range(3)
]

SUBSTRATE = [
    {
        "header": {"height": 5 + k, "hash": H(k), "parentHash": H(k + 50), "stateRoot": "0xs", "extrinsicsRoot": "0xe", "digest": {"logs": [1]}, "specName": "kusama", "specVersion": 9, "implName": "i", "implVersion": 0, "timestamp": 1_600_000_000_123},
        "extrinsics": [{"index": 0, "version": 4, "success": True, "hash": "0xx", "fee": "123456789012345678901234567890", "signature": {"address": "a"}}],
        "calls": [{"extrinsicIndex": 0, "address": [], "name": "Utility.batch", "args": {"calls": []}, "success": True}, {"extrinsicIndex": 0, "address": [0], "name": "Ethereum.transact", "args": {"a": "é"}, "success": False, "error": {"x": 1}, "_ethereumTransactTo": "0xto", "_ethereumTransactSighash": "0x12345678"}],
        "events": [{"index": 0, "name": "EVM.Log", "args": {"b": [1, 2]}, "phase": "ApplyExtrinsic", "extrinsicIndex": 0, "callAddress": [0], "topics": ["0x1"], "_evmLogAddress": "0xlog", "_evmLogTopics": ["0xt0", "0xt1"]}, {"index": 1, "name": "Balances.Transfer", "args": None, "phase": "Finalization", "topics": []}],
    }
    for k in range(2)
]

SOLANA = [
    {
        "header": {"height": 7, "hash": "h7", "slot": 9, "parentSlot": 8, "parentHash": "h6", "timestamp": 1_700_000_000},
        "transactions": [
            {"transactionIndex": 0, "version": v, "accountKeys": ["p" * 32, "q"], "addressTableLookups": [{"accountKey": "abc", "readonlyIndexes": [1, 2], "writableIndexes": [3]}] if v == 0 else [], "numReadonlySignedAccounts": 0, "numReadonlyUnsignedAccounts": 1, "numRequiredSignatures": 1, "recentBlockhash": "r", "signatures": ["sig"], "err": None if v == 0 else {"InstructionError": [0]}, "computeUnitsConsumed": "18446744073709551615", "fee": "5000", "loadedAddresses": {"readonly": ["ro"], "writable": []}, "hasDroppedLogMessages": False}
            | {"transactionIndex": i}
            for i, v in enumerate([0, "legacy"])
        ],
        "instructions": [{"transactionIndex": 0, "instructionAddress": [0], "programId": "P1", "accounts": [f"acc{i}" for i in range(18)], "data": "2NEpo7TZRRrLZSi2U", "isCommitted": True, "hasDroppedLogMessages": False}, {"transactionIndex": 0, "instructionAddress": [0, 1], "programId": "P2", "accounts": [], "data": "", "isCommitted": False, "hasDroppedLogMessages": False, "error": "e"}],
        "logs": [{"transactionIndex": 0, "logIndex": 0, "instructionAddress": [0], "programId": "P1", "kind": "log", "message": "hé"}],
        "balances": [{"transactionIndex": 0, "account": "a", "pre": "1", "post": "18446744073709551615"}],
        "tokenBalances": [{"transactionIndex": 0, "account": "t", "preMint": "m", "preDecimals": 6, "preAmount": "10"}],
        "rewards": [{"pubkey": "v", "lamports": "-5", "postBalance": "7", "rewardType": "fee"}],
    }
]

TRON = [
    {
        "header": {"height": 3, "hash": "h3", "parentHash": "h2", "txTrieRoot": "r", "version": 28, "timestamp": 1_500_000_000_000, "witnessAddress": "w"},
        "transactions": [
            {"transactionIndex": 0, "hash": "t0", "type": "TransferContract", "ret": [{"contractRet": "SUCCESS"}], "signature": ["s"], "parameter": {"value": {"owner_address": "o", "to_address": "to"}}, "rawDataHex": "0a02", "fee": "100", "timestamp": 1_500_000_000_001, "expiration": 1_500_000_060_000},
            {"transactionIndex": 1, "hash": "t1", "type": "TriggerSmartContract", "parameter": {"value": {"owner_address": "o", "contract_address": "c", "data": "a9059cbb00"}}, "rawDataHex": "0a"},
        ],
        "logs": [{"transactionIndex": 1, "logIndex": 0, "address": "c", "data": "00", "topics": ["x", "y"]}],
        "internalTransactions": [{"transactionIndex": 1, "internalTransactionIndex": 0, "hash": "i", "callerAddress": "c", "transferToAddress": "z", "callValueInfo": [{"callValue": 1}], "note": "call"}],
    }
]

FUEL = [
    {
        "header": {"height": 11, "hash": "h", "daHeight": "12", "transactionsRoot": "r", "transactionsCount": "1", "messageReceiptCount": "0", "prevRoot": "p", "applicationHash": "a", "time": "4611686020137152052", "eventInboxRoot": "e", "consensusParametersVersion": 1, "stateTransitionBytecodeVersion": 2, "messageOutboxRoot": "m"},
        "transactions": [{"index": 0, "hash": "t", "type": "Script", "isScript": True, "isCreate": False, "isMint": False, "isUpgrade": False, "isUpload": False, "inputAssetIds": ["aa", "bbb"], "policies": {"witnessLimit": "5", "maxFee": "7"}, "inputContract": {"utxoId": "u", "contractId": "ci"}, "outputContract": {"inputIndex": 1, "stateRoot": "sr"}, "status": {"type": "Success"}, "scriptGasLimit": "18446744073709551615", "rawPayload": "0x0011"}],
        "inputs": [{"type": "InputCoin", "index": 0, "transactionIndex": 0, "utxoId": "u", "owner": "o", "amount": "9", "assetId": "as", "txPointer": "tp", "witnessIndex": 0, "predicateGasUsed": "0", "predicate": "0x", "predicateData": "0x"}, {"type": "InputContract", "index": 1, "transactionIndex": 0, "utxoId": "u2", "contractId": "c", "balanceRoot": "b", "stateRoot": "s", "txPointer": "t"}],
        "outputs": [{"type": "ContractCreated", "index": 0, "transactionIndex": 0, "contract": "cc", "stateRoot": "csr"}, {"type": "ContractOutput", "index": 1, "transactionIndex": 0, "inputIndex": 1, "balanceRoot": "br", "stateRoot": "osr"}],
        "receipts": [{"index": 0, "transactionIndex": 0, "contract": "c", "receiptType": "LOG_DATA", "pc": "1", "is": "2", "len": "3", "data": "0xdd"}],
    }
]

STARKNET = [
    {
        "number": 20 + k, "hash": f"h{k}", "parent_hash": "hp", "status": "ACCEPTED", "new_root": "n", "timestamp": 1_650_000_000, "sequencer_address": "s", "starknet_version": "0.13", "l1_gas_price": {"price_in_fri": "0x1", "price_in_wei": "0x2"},
        "writer_txs": [{"block_number": 20 + k, "transaction_index": 0, "type": "INVOKE", "nonce": "0x1f", "sender_address": "0xs", "calldata": ["0x1", "0x22"], "resource_bounds": {"l1_gas": {"max_amount": "0xa"}}, "receipt": {"transaction_hash": "0xth", "actual_fee": {"amount": "0xf", "unit": "WEI"}, "finality_status": "L1"}}],
        "writer_events": [{"block_number": 20 + k, "transaction_index": 0, "event_index": 0, "from_address": "0xflat", "keys": ["k"] * 6, "data": []}],
        "writer_state_update": {"block_number": 20 + k, "new_root": "n", "old_root": "o", "state_diff": {"nonces": [{"contract_address": "c", "nonce": "0x1"}]}},
        "writer_storage_diffs": [{"block_number": 20 + k, "address": "ad", "storage_entries": [{"key": "k", "value": "v"}, {"key": "k2", "value": "v2"}]}],
    }
    | (
        {"writer_call_traces": [
            {"block_number": 20, "transaction_index": 0, "trace_type": "INVOKE", "invocation_type": "execute", "trace_address": [0], "contract_address": "0xc", "calldata": ["0x1"], "result": [], "events": [{"order": 4, "keys": ["a", "bb"], "data": ["d"]}], "messages": [{"order": 0, "from_address": "0xF", "to_address": "0xT", "payload": ["p"]}]},
            {"block_number": 20, "transaction_index": 0, "trace_type": "INVOKE", "invocation_type": "execute", "trace_address": [0, 1], "revert_reason": "r", "events": [{"order": 5, "keys": [], "data": []}], "messages": []},
        ]} if k == 0 else {}
    )
    for k in range(2)
]

BLOCKS = {"eth": EVM, "substrate": SUBSTRATE, "solana": SOLANA, "tron": TRON, "fuel": FUEL, "starknet": STARKNET}


@pytest.fixture(scope="module")
def lakes(spark, tmp_path_factory):
    """Of each chain: its tables, and the folder of a lake with them in chunks of two blocks."""
    out = {}
    for name, blocks in BLOCKS.items():
        raw, folder = RAW[name], tmp_path_factory.mktemp(name)
        (folder / "raw").mkdir()
        (folder / "raw" / "blocks.jsonl").write_text("".join(json.dumps(b) + "\n" for b in blocks))
        tables = ingest(raw, sinks.read_raw_blocks(spark, str(folder / "raw"), raw_schema(raw)))
        heights = sorted(r.number for r in tables["blocks"].select("number").collect())
        first = heights[0]
        chunked = {n: t.withColumn("chunk", F.floor((F.col("number" if n == "blocks" else "block_number") - first) / 2).cast("int")) for n, t in tables.items()}
        chunks = spark.createDataFrame([(i // 2, first, heights[i], heights[min(i + 1, len(heights) - 1)], "abcd") for i in range(0, len(heights), 2)], "chunk int, top long, first_block long, last_block long, last_hash string")
        rules = {r.table: r for r in raw.tables}
        sinks.write_lake(chunked, raw.model.tables | {"blocks": raw.model.block}, chunks, str(folder / "lake"), rules=rules)
        out[name] = (tables, str(folder / "lake"))
    return out


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", BLOCKS)
def test_tables_have_the_columns_of_the_model(lakes, name):
    """Every field that a request can name is a column, and so is what scans and relations go by."""
    model, (tables, _) = MODELS[name], lakes[name]
    assert set(tables) == set(model.tables) | {"blocks"}
    for item in model.items:
        have = set(tables[item.table].columns)
        for scan in (s for s in model.scans.values() if s.table == item.table):
            assert {*scan.filters.values(), *scan.fixed, *scan.at_least.values(), *scan.equal.values()} <= have
        assert {"block_number", *model.tables[item.table].key} <= have
        lost = {P.snake(f) for f in model.fields[item.entity]} - have - {"topics", "accounts", "keys", "recent_blockhash", "resource_bounds", "actual_fee"}
        assert not lost, (item.table, lost)


@pytest.mark.parametrize("name", BLOCKS)
def test_written_lake_reads_back(spark, lakes, name):
    tables, root = lakes[name]
    for table, df in tables.items():
        back = read_table(spark, root, table)
        assert set(df.columns) <= set(back.columns) and rows(back, *df.columns) == rows(df, *df.columns)
        rule = next((r for r in RAW[name].tables if r.table == table), None)
        if rule:
            assert {f"{c}_size" for c in rule.sizes.split()} <= set(back.columns) and (table == "blocks" or "_idx" in back.columns)


def everything(model):
    """A request for all rows, by all relations, and all fields."""
    flags = {s: {r.flag: True for item in model.items for r in item.relations if r.scan == s} for s in model.scans}
    return {"type": model.name, "fromBlock": 0, "fields": {e: dict.fromkeys(f, True) for e, f in model.fields.items()}} | {s: [flags[s]] for s in model.scans}


@pytest.mark.parametrize("name", BLOCKS)
def test_requests_read_what_was_ingested(spark, lakes, name):
    model, (_, root) = MODELS[name], lakes[name]
    got = [json.loads(r.value) for r in to_json(query(model, lambda t: read_table(spark, root, t), everything(model), limit=1 << 40)).orderBy("block_number").collect()]
    assert len(got) == len(BLOCKS[name]) and all(b["header"]["hash"] for b in got)
    first = got[0]
    if name == "eth":
        assert first["transactions"][0]["value"] == "0xffffffffffffffffffff" and first["transactions"][0]["sighash"] == "0x12345678" and first["header"]["timestamp"] == 100_000_000
        assert [t["status"] for t in first["transactions"]] == [1, 1] and first["transactions"][1]["contractAddress"] == "0xmade"
        assert first["logs"][0]["topics"] == ["0xt0", "0xt1"] and first["logs"][0]["address"] == "0xabc"
        assert [(t["transactionIndex"], t["traceAddress"], t["type"]) for t in first["traces"]] == [(0, [], "call"), (0, [0], "create"), (0, [1], "suicide"), (1, [], "create"), (1, [0], "call")]
        assert first["traces"][1]["result"] == {"code": "0xcode", "address": "0xnew"} and first["traces"][1]["revertReason"] == "why" and first["traces"][4]["action"]["type"] == "staticcall"
        assert {(d["address"], d["key"], d["kind"], d["prev"], d["next"]) for d in first["stateDiffs"]} == {
            ("0xa", "balance", "*", "0x5", "0x4"), ("0xa", "0xs1", "*", "0x1", "0x9"), ("0xa", "0xs2", "-", "0x2", None), ("0xc", "code", "+", None, "0xcc"),
            ("0xd", "balance", "*", "0x1", "0x2"), ("0xd", "nonce", "+", None, "0x1"), ("0xd", "0xs", "-", "0x3", None),
        }
    if name == "substrate":
        assert first["header"]["timestamp"] == 1_600_000_000_123 and first["header"]["digest"] == {"logs": [1]} and first["extrinsics"][0]["fee"] == "123456789012345678901234567890"
        assert [c["args"] for c in first["calls"]] == [{"calls": []}, {"a": "é"}] and first["events"][0]["args"] == {"b": [1, 2]} and first["events"][1]["args"] is None
    if name == "solana":
        assert [t["version"] for t in first["transactions"]] == [0, "legacy"] and first["transactions"][0]["computeUnitsConsumed"] == "18446744073709551615"
        assert first["instructions"][0]["accounts"] == [f"acc{i}" for i in range(18)] and first["instructions"][0]["d4"] == "0x" + b"Hell".hex() and first["instructions"][1]["d1"] == "0x"
        assert first["rewards"][0]["lamports"] == "-5" and first["transactions"][0]["feePayer"] == "p" * 32
    if name == "tron":
        assert first["transactions"][0]["ret"] == [{"contractRet": "SUCCESS"}] and first["internalTransactions"][0]["callValueInfo"] == [{"callValue": 1}] and first["transactions"][0]["fee"] == "100"
    if name == "fuel":
        assert first["inputs"][0]["utxoId"] == "u" and first["inputs"][1]["contractId"] == "c" and first["outputs"][0]["createdStateRoot"] == "csr" and first["outputs"][1]["stateRoot"] == "osr"
        assert first["transactions"][0]["policies"]["maxFee"] == "7" and first["transactions"][0]["inputContract"]["utxoId"] == "u" and first["header"]["time"] == "4611686020137152052"
    if name == "starknet":
        assert [(e["eventIndex"], e["traceAddress"], e["keys"]) for b in got for e in b["events"]] == [(4, [0], ["a", "bb"]), (0, [], ["k"] * 6)]
        assert first["transactions"][0]["resourceBounds"]["l1GasMaxAmount"] == "0xa" and first["messages"][0]["fromAddress"] == "0xf" and first["transactions"][0]["nonce"] == 31


def test_requests_by_hidden_columns(spark, lakes):
    ask = lambda name, request: [json.loads(r.value) for r in to_json(query(MODELS[name], lambda t: read_table(spark, lakes[name][1], t), {"fromBlock": 0} | request)).orderBy("block_number").collect()]
    evm_logs = ask("substrate", {"evmLogs": [{"address": ["0xlog"], "topic0": ["0xt0"], "call": True}], "fields": {"event": {"name": True}, "call": {"name": True}}})
    assert [([e["name"] for e in b["events"]], [c["name"] for c in b["calls"]]) for b in evm_logs] == [(["EVM.Log"], ["Ethereum.transact"])] * 2
    tron = ask("tron", {"triggerSmartContractTransactions": [{"sighash": ["a9059cbb"], "logs": True}], "transferTransactions": [{"to": ["to"]}], "fields": {"transaction": {"hash": True}}})
    assert [t["hash"] for t in tron[0]["transactions"]] == ["t0", "t1"] and len(tron[0]["logs"]) == 1
    solana = ask("solana", {"instructions": [{"d1": ["0x48"], "a15": ["acc15"], "innerInstructions": True, "transaction": True}], "fields": {"instruction": {"programId": True}}})
    assert [i["programId"] for i in solana[0]["instructions"]] == ["P1", "P2"] and len(solana[0]["transactions"]) == 1


def test_files_have_the_rules_layout(spark, lakes, tmp_path):
    rule = next(r for r in RAW["eth"].tables if r.table == "transactions")
    model = RAW["eth"].model
    many = lakes["eth"][0]["transactions"].crossJoin(spark.range(500).withColumnRenamed("id", "n")).withColumn("transaction_index", F.col("n").cast("int")).drop("n").withColumn("chunk", F.lit(0))
    sinks.write_tables({"transactions": many}, model.tables, str(tmp_path / "t"), rules={"transactions": TableRule(rule, rows=1000)})
    file = pq.ParquetFile(next((tmp_path / "t" / "transactions").rglob("*.parquet")))
    groups = [file.metadata.row_group(i) for i in range(file.metadata.num_row_groups)]
    assert len(groups) == 3 and max(g.num_rows for g in groups) == 1000
    column = {groups[0].column(i).path_in_schema: groups[0].column(i) for i in range(groups[0].num_columns)}
    assert column["from"].statistics is not None and column["from"].has_dictionary_page and not column["hash"].has_dictionary_page
    assert column["hash"].statistics is None or not column["hash"].statistics.has_min_max
    assert file.read(["_idx"]).column(0).to_pylist() == list(range(many.count()))


def TableRule(rule, **other):
    from dataclasses import replace

    return replace(rule, **other)


def test_missing_members_and_no_blocks(spark, tmp_path):
    for name, raw in RAW.items():
        schema = raw_schema(raw)
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text('{"number":"0x1"}\n{"header":{"height":1}}\n' if name in ("eth",) else '{"number":1}\n{"header":{"height":1}}\n')
        found = ingest(raw, sinks.read_raw_blocks(spark, str(tmp_path / name), schema), keep=False)
        assert all(df.count() == (2 if t == "blocks" else 0) for t, df in found.items())
        assert all(df.count() == 0 for df in ingest(raw, spark.createDataFrame([], schema), keep=False).values())


def test_base58_alphabet():
    assert len(set(BASE58)) == 58


@pytest.mark.parametrize(("limit", "page_bytes"), [(3000, None), (1 << 40, 4000), (1, 1)])
def test_page_after_page_is_the_whole(spark, lakes, limit, page_bytes):
    model, (_, root) = MODELS["eth"], lakes["eth"]
    tables = lambda t: read_table(spark, root, t)
    request = {"logs": [{"topic0": ["0xt0"], "transaction": True}], "traces": [{"type": ["create"]}], "fields": {"transaction": {"input": True, "hash": True}, "log": {"data": True}, "trace": {"createFrom": True}}}
    chunks = spark.createDataFrame([(100, 101), (102, 102)], "first_block long, last_block long")
    whole = {r.block_number: r.value for r in to_json(query(model, tables, request | {"fromBlock": 0}, chunks=chunks)).collect()}
    got, first, pages = {}, 0, 0
    while first is not None:
        page, end = next_page(model, tables, request | {"fromBlock": first}, limit, chunks, page_bytes)
        rows = page.collect()
        assert not got.keys() & {r.block_number for r in rows} and rows
        got |= {r.block_number: r.value for r in rows}
        first, pages = None if end is None else end + 1, pages + 1
    assert got == whole and pages == (3 if limit == 1 or page_bytes == 1 else pages)


def test_many_scans_of_a_table_are_one_pass(spark, lakes):
    """Six kinds of events with three relations each: one pass over events finds all keys, one more reads the items."""
    model, (_, root) = MODELS["substrate"], lakes["substrate"]
    opened = Counter()

    def tables(name):
        opened[name] += 1
        return read_table(spark, root, name)

    events = ("events", "evmLogs", "contractsEvents", "gearMessagesEnqueued", "gearUserMessagesSent", "reviveContractEmitted")
    flags = {"call": True, "stack": True, "extrinsic": True}
    request = {"fromBlock": 0, "fields": {"event": {"name": True}, "call": {"name": True}}} | {s: [flags] for s in events}
    blocks = query(model, tables, request)
    assert opened["events"] == 2
    got = [json.loads(r.value) for r in to_json(blocks).orderBy("block_number").collect()]
    assert [([e["name"] for e in b["events"]], [c["name"] for c in b["calls"]], len(b["extrinsics"])) for b in got] == [(["EVM.Log", "Balances.Transfer"], ["Utility.batch", "Ethereum.transact"], 1)] * 2
    assert blocks._jdf.queryExecution().executedPlan().toString().count("events.parquet") <= 2
