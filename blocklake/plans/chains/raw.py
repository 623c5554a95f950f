"""Raw blocks of the six chains and the tables they become. Names and types are fixed by the data; all else follows from rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklake.operators import ingest as I
from blocklake.plans.chains import evm, fuel, solana, starknet, substrate, tron
from blocklake.plans.tables import RawModel, TableRule, indexed

SUBSTRATE = RawModel(
    substrate.MODEL, "header.height",
    (
        TableRule("blocks", "block", "header", {"long": "specVersion implVersion", "millis": "timestamp", "json": "digest"}, dictionary="spec_name impl_name validator", statistics="number spec_name spec_version impl_name impl_version timestamp validator"),
        TableRule("extrinsics", "extrinsic", "extrinsics", {"int": "index version", "json": "signature error", "big": "fee tip", "bool": "success"}, statistics="block_number index version _idx"),
        TableRule(
            "calls", "call", "calls", {"int": "extrinsicIndex", "ints": "address", "json": "args origin error", "bool": "success"},
            hidden=indexed(substrate.MODEL, "_ethereum_transact_to", "_ethereum_transact_sighash"), sizes="args", rows=20_000,
            dictionary="name _ethereum_transact_to _ethereum_transact_sighash", statistics="block_number extrinsic_index name _ethereum_transact_to _ethereum_transact_sighash _idx",
        ),
        TableRule(
            "events", "event", "events", {"int": "index extrinsicIndex", "json": "args", "ints": "callAddress", "texts": "topics"},
            lists=(("_evmLogTopics", "_evm_log_topic", 4, ""), ("_reviveTopics", "_revive_topic", 4, "")),
            hidden=indexed(substrate.MODEL, "_evm_log_address", "_contract_address", "_gear_program_id", "_revive_contract"), sizes="args", rows=20_000,
            dictionary="name phase _evm_log_address _evm_log_topic0 _contract_address _gear_program_id", statistics="block_number index extrinsic_index name _evm_log_address _evm_log_topic0 _contract_address _gear_program_id _idx",
        ),
    ),
)

_LOOKUPS = "array<struct<accountKey:string,readonlyIndexes:array<smallint>,writableIndexes:array<smallint>>>"


def _transactions(df: DataFrame) -> DataFrame:
    """Who pays, structs with names in snake case, and sizes of nested lists."""
    text = lambda c: F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + F.length(x)), F.lit(0).cast("long"))
    lookups = F.transform("address_table_lookups", lambda x: F.struct(x["accountKey"].alias("account_key"), x["readonlyIndexes"].alias("readonly_indexes"), x["writableIndexes"].alias("writable_indexes")))
    size = F.aggregate("address_table_lookups", F.lit(0).cast("long"), lambda n, x: n + F.length(x["accountKey"]) + F.size(x["readonlyIndexes"]) + F.size(x["writableIndexes"]))
    loaded = text(F.col("loaded_addresses.writable")) + text(F.col("loaded_addresses.readonly"))
    return df.withColumns({"fee_payer": F.get("account_keys", F.lit(0)), "address_table_lookups_size": F.coalesce(size, F.lit(0).cast("long")), "loaded_addresses_size": loaded, "address_table_lookups": lookups})


SOLANA = RawModel(
    solana.MODEL, "header.height",
    (
        TableRule("blocks", "block", "header", {"long": "slot parentSlot", "seconds": "timestamp"}, statistics="number slot timestamp"),
        TableRule(
            "transactions", "transaction", "transactions",
            {"int": "transactionIndex", "version": "version", "texts": "accountKeys signatures", _LOOKUPS: "addressTableLookups", "short": "numReadonlySignedAccounts numReadonlyUnsignedAccounts numRequiredSignatures", "json": "err", "u64": "fee computeUnitsConsumed", "struct<readonly:array<string>,writable:array<string>>": "loadedAddresses", "bool": "hasDroppedLogMessages"},
            drop="feePayer", list_sizes={"account_keys_size": "accountKeys", "signatures_size": "signatures"}, finish=_transactions, rows=5_000, dictionary="fee_payer", statistics="_idx fee_payer block_number transaction_index has_dropped_log_messages",
        ),
        TableRule(
            "instructions", "instruction", "instructions", {"int": "transactionIndex", "ints": "instructionAddress", "u64": "computeUnitsConsumed", "bool": "isCommitted hasDroppedLogMessages"},
            lists=(("accounts", "a", 16, "rest_accounts"),), drop="d1 d2 d4 d8", sizes="data", list_sizes={"accounts_size": "accounts"}, finish=I.discriminators, rows=20_000,
            dictionary="program_id d1 " + " ".join(f"a{i}" for i in range(16)), statistics="_idx block_number transaction_index program_id d1 d2 d4 d8 has_dropped_log_messages " + " ".join(f"a{i}" for i in range(16)),
        ),
        TableRule("logs", "log", "logs", {"int": "transactionIndex logIndex", "ints": "instructionAddress"}, sizes="message", rows=50_000, dictionary="program_id kind", statistics="_idx block_number transaction_index log_index program_id kind"),
        TableRule("balances", "balance", "balances", {"int": "transactionIndex", "u64": "pre post"}, rows=20_000, dictionary="account", statistics="_idx account block_number transaction_index"),
        TableRule(
            "token_balances", "tokenBalance", "tokenBalances", {"int": "transactionIndex preDecimals postDecimals", "u64": "preAmount postAmount"}, rows=8_000,
            dictionary="account pre_mint post_mint pre_owner post_owner pre_program_id post_program_id", statistics="_idx account pre_mint post_mint pre_owner post_owner pre_program_id post_program_id block_number transaction_index",
        ),
        TableRule("rewards", "reward", "rewards", {"long": "lamports", "u64": "postBalance", "short": "commission"}, dictionary="pubkey reward_type", statistics="_idx pubkey reward_type block_number"),
    ),
)


def _parameters(df: DataFrame) -> DataFrame:
    return df.withColumns(I.contract_parameters(F.col("parameter"), F.col("type")))


_TRON_INDEX = "_transfer_contract_owner _transfer_contract_to _transfer_asset_contract_owner _transfer_asset_contract_to _transfer_asset_contract_asset _trigger_smart_contract_owner _trigger_smart_contract_contract _trigger_smart_contract_sighash"

TRON = RawModel(
    tron.MODEL, "header.height",
    (
        TableRule("blocks", "block", "header", {"int": "version", "millis": "timestamp"}, statistics="number"),
        TableRule(
            "transactions", "transaction", "transactions",
            {"int": "transactionIndex permissionId", "json": "ret parameter cancelUnfreezeV2Amount", "texts": "signature", "long": "feeLimit fee withdrawAmount unfreezeAmount withdrawExpireAmount energyFee energyUsage energyUsageTotal netUsage netFee originEnergyUsage energyPenaltyTotal", "millis": "timestamp"},
            sizes="raw_data_hex", finish=_parameters, dictionary="type ret", statistics=f"_idx block_number transaction_index type {_TRON_INDEX}",
        ),
        TableRule("logs", "log", "logs", {"int": "transactionIndex logIndex"}, lists=(("topics", "topic", 4, ""),), sizes="data", dictionary="address topic0", statistics="_idx address topic0 block_number transaction_index log_index"),
        TableRule("internal_transactions", "internalTransaction", "internalTransactions", {"int": "transactionIndex internalTransactionIndex", "json": "callValueInfo", "bool": "rejected"}, statistics="_idx block_number transaction_index internal_transaction_index transfer_to_address caller_address"),
    ),
)


def _structs(df: DataFrame) -> DataFrame:
    """Nested objects with members in snake case, numbers as numbers."""
    fields = {"policies": (("witnessLimit", "maturity", "maxFee", "tip"), ()), "input_contract": ((), ("utxoId", "balanceRoot", "stateRoot", "txPointer", "contractId")), "output_contract": (("inputIndex",), ("balanceRoot", "stateRoot"))}
    return df.withColumns({c: I.normalise_struct(F.col(c), numbers, texts) for c, (numbers, texts) in fields.items()})


_LISTS = "input_asset_ids inputAssetIds;input_contracts inputContracts;witnesses witnesses;storage_slots storageSlots;proof_set proofSet"

FUEL = RawModel(
    fuel.MODEL, "header.height",
    (
        TableRule("blocks", "block", "header", {"u64": "daHeight transactionsCount messageReceiptCount time consensusParametersVersion stateTransitionBytecodeVersion"}, sources={"number": "height"}, drop="height", statistics="number"),
        TableRule(
            "transactions", "transaction", "transactions",
            {"int": "index bytecodeWitnessIndex subsectionIndex subsectionsNumber", "texts": "inputAssetIds inputContracts witnesses storageSlots proofSet", "json": "policies inputContract outputContract status upgradePurpose", "u64": "scriptGasLimit mintAmount mintGasPrice", "long": "maturity", "bool": "isScript isCreate isMint isUpgrade isUpload"},
            sizes="script_data raw_payload", list_sizes={f"{a}_size": b for a, b in (x.split() for x in _LISTS.split(";"))}, finish=_structs, dictionary="type", statistics="_idx block_number index type",
        ),
        TableRule("receipts", "receipt", "receipts", {"int": "index transactionIndex", "u64": "pc is amount gas param1 param2 val ptr reason ra rb rc rd len result gasUsed"}, sizes="data", rows=20_000, dictionary="contract receipt_type", statistics="_idx block_number transaction_index index contract receipt_type"),
        TableRule(
            "inputs", "input", "inputs", {"int": "index transactionIndex coinWitnessIndex messageWitnessIndex", "u64": "coinAmount coinPredicateGasUsed messageAmount messagePredicateGasUsed"},
            variants={"coin": "InputCoin", "contract": "InputContract", "message": "InputMessage"}, sizes="coin_predicate message_predicate", rows=15_000, dictionary="type coin_owner coin_asset_id", statistics="_idx block_number transaction_index index type coin_owner coin_asset_id",
        ),
        TableRule(
            "outputs", "output", "outputs", {"int": "index transactionIndex contractInputIndex", "u64": "coinAmount changeAmount variableAmount"},
            variants={"coin": "CoinOutput", "contract": "ContractOutput", "contractCreated": "ContractCreated", "change": "ChangeOutput", "variable": "VariableOutput"}, rows=15_000, dictionary="type", statistics="_idx block_number transaction_index index type",
        ),
    ),
)

_STATE = "map<string,struct<balance:string,code:string,nonce:string,storage:map<string,string>>>"
_LOG = "struct<blockNumber:string,logIndex:string,transactionIndex:string,transactionHash:string,address:string,data:string,topics:array<string>>"
_ACTION = "struct<from:string,to:string,value:string,gas:string,input:string,init:string,address:string,refundAddress:string,balance:string,author:string,rewardType:string,callType:string>"
_TRACE = f"array<struct<traceAddress:array<int>,subtraces:int,type:string,error:string,action:{_ACTION},result:struct<address:string,code:string,gasUsed:string,output:string>>>"
_RECEIPT = "gasUsed cumulativeGasUsed effectiveGasPrice type status contractAddress l1Fee l1FeeScalar l1GasPrice l1GasUsed l1BlobBaseFee l1BlobBaseFeeScalar l1BaseFeeScalar"


def _evm_transactions(df: DataFrame) -> DataFrame:
    """Sighashes, and what traces tell of transactions without a receipt."""
    frame = F.from_json("_frame", "type string, error string, to string")
    top = F.get(F.filter("_trace", lambda t: F.size(t["traceAddress"]) == 0), F.lit(0))
    told = I.status_from_traces(F.when(F.col("_frame").isNotNull(), frame), F.when(top.isNotNull(), F.struct(top["type"].alias("type"), top["error"].alias("error"), top["result"]["address"].alias("address"))))
    without = F.col("_status").isNull()
    rows = df.withColumns({"sighash": I.sighash(F.col("input")), "status": F.when(without, told["status"]).otherwise(I.hex_to_int(F.col("_status"))).cast("tinyint"), "contract_address": F.when(without, told["contract_address"]).otherwise(F.col("contract_address"))})
    return rows.drop("_frame", "_trace", "_status")


#: Where the members of a call frame go, by the kind of trace.
_FRAME = {
    "create": {"from": "from", "value": "value", "gas": "gas", "init": "input", "result_gas_used": "gas_used", "result_code": "output", "result_address": "to"},
    "call": {"from": "from", "to": "to", "value": "value", "gas": "gas", "input": "input", "type": "call_type", "result_gas_used": "gas_used", "result_output": "output"},
    "suicide": {"address": "from", "refund_address": "to", "balance": "value"},
}


def _evm_more(blocks: DataFrame) -> dict[str, DataFrame]:
    """Logs of the block or of receipts; traces and state differences in either of the two forms, call frames first."""
    number = I.hex_to_int(F.col("number")).cast("int")
    logs = blocks.select(F.explode(I.choose_logs(F.col("logs_"), F.filter("transactions.receipt_.logs", lambda x: x.isNotNull()))).alias("l"))
    place = lambda c: I.hex_to_int(F.col(f"l.{c}")).cast("int")
    first, _ = I.split_list(F.col("l.topics"), 4)
    log_table = logs.select(place("blockNumber").alias("block_number"), place("logIndex").alias("log_index"), place("transactionIndex").alias("transaction_index"), F.col("l.transactionHash").alias("transaction_hash"), "l.address", "l.data", *[c.alias(f"topic{i}") for i, c in enumerate(first)])
    tx = blocks.select(number.alias("block_number"), F.explode("transactions").alias("t")).withColumn("transaction_index", I.hex_to_int(F.col("t.transactionIndex")).cast("int"))
    frames = I.flatten_call_frames(tx.where("t.debugFrame_ is not null").select("block_number", "transaction_index", F.col("t.debugFrame_.result").alias("frame")))
    by_frame = {f"{kind}_{c}": F.when(F.col("type") == kind, F.col(source)) for kind, columns in _FRAME.items() for c, source in columns.items()}
    traced = frames.select("block_number", "transaction_index", "trace_address", "subtraces", "type", "error", "revert_reason", *[c.alias(k) for k, c in by_frame.items()]).withColumn("call_sighash", I.sighash(F.col("call_input")))
    other = tx.where("t.debugFrame_ is null")
    flat = other.select("block_number", F.transform("t.traceReplay_.trace", lambda x: x.withField("transactionPosition", F.col("transaction_index"))).alias("traces"))
    parity = I.flatten_parity_traces(flat).withColumn("revert_reason", F.lit(None).cast("string")).withColumn("call_type", F.lit(None).cast("string"))
    calls = other.select("block_number", F.explode("t.traceReplay_.trace").alias("x"), "transaction_index").where("x.type = 'call'").select("block_number", "transaction_index", F.col("x.traceAddress").alias("trace_address"), F.col("x.action.callType").alias("kind"))
    parity = parity.join(calls, ["block_number", "transaction_index", "trace_address"], "left").withColumn("call_type", F.col("kind")).drop("kind")
    traces = traced.unionByName(parity, allowMissingColumns=True)
    states = tx.where("t.debugStateDiff_ is not null")
    diffs = I.prestate_diff(_state(states, "t.debugStateDiff_.result.pre"), _state(states, "t.debugStateDiff_.result.post")).unionByName(I.parity_state_diff(_state(tx.where("t.debugStateDiff_ is null"), "t.traceReplay_.stateDiff").withColumnRenamed("value", "diff")))
    return {"logs": log_table, "traces": traces, "statediffs": diffs}


def _state(tx: DataFrame, accounts: str) -> DataFrame:
    """``block_number, transaction_index, address, key, value`` of a map of accounts: balance, code, nonce and slots that are there."""
    rows = tx.select("block_number", "transaction_index", F.explode(accounts).alias("address", "a"))
    known = F.map_from_arrays(F.array(*[F.lit(k) for k in ("balance", "code", "nonce")]), F.array("a.balance", "a.code", "a.nonce"))
    every = F.concat(F.map_entries(known), F.coalesce(F.map_entries("a.storage"), F.array().cast("array<struct<key:string,value:string>>")))
    return rows.select("block_number", "transaction_index", "address", F.explode(every).alias("e")).select("block_number", "transaction_index", "address", "e.key", "e.value").where("value is not null")


EVM = RawModel(
    evm.MODEL, "number",
    (
        TableRule("blocks", "block", "", {"hexint": "size l1BlockNumber", "hexseconds": "timestamp"}, sizes="extra_data", rows=2_000, statistics="number"),
        TableRule(
            "transactions", "transaction", "transactions", {"hexint": "transactionIndex", "hexlong": "nonce l1BlobBaseFeeScalar l1BaseFeeScalar", "hexbyte": "yParity", "hexu64": "chainId", "hexshort": "type", "texts": "blobVersionedHashes", _TRACE: "_trace"},
            sources={n: f"receipt_.{n}" for n in _RECEIPT.split()}, drop="sighash status", hidden={"_status": "receipt_.status", "_frame": "debugFrame_.result", "_trace": "traceReplay_.trace"}, sizes="input", finish=_evm_transactions,
            dictionary="from to sighash", statistics="_idx from to sighash block_number transaction_index",
        ),
    ),
    "hexint", _evm_more, f"logs_ array<{_LOG}>;transactions[].receipt_.logs array<{_LOG}>;transactions[].debugStateDiff_.result.pre {_STATE};transactions[].debugStateDiff_.result.post {_STATE};transactions[].traceReplay_.stateDiff {_STATE}",
)

_CALL = "writer_call_traces"
_INNER = "array<struct<order:int,keys:array<string>,data:array<string>>>"
_MESSAGE = "array<struct<order:int,from_address:string,to_address:string,payload:array<string>>>"


def _snake_sources(model, entity: str, under: str = "", **other: str) -> dict[str, str]:
    """Raw members that are in snake case already."""
    from blocklake.functions.project import snake

    return {f: other.get(f, under + snake(f)) for f in model.fields[entity]}


def _starknet_more(blocks: DataFrame) -> dict[str, DataFrame]:
    """Events and messages of calls that were not reverted; events of blocks without calls; state updates and their slots."""
    calls = blocks.select(F.explode(_CALL).alias("c")).where("c.revert_reason is null")
    at = ["c.block_number", "c.transaction_index", "c.trace_address"]
    events = calls.select(*at, F.col("c.contract_address").alias("from_address"), F.explode("c.events").alias("e")).select("block_number", "transaction_index", "trace_address", "from_address", F.col("e.order").alias("event_index"), "e.keys", "e.data")
    flat = blocks.where(f"{_CALL} is null").select(F.explode("writer_events").alias("e")).select("e.block_number", "e.transaction_index", F.array().cast("array<int>").alias("trace_address"), "e.from_address", "e.event_index", "e.keys", "e.data")
    rows = events.unionByName(flat)
    first, rest = I.split_list(F.col("keys"), 4)
    size = F.aggregate("keys", F.lit(0).cast("long"), lambda n, x: n + F.length(x))
    event_table = rows.withColumns({**{f"key{i}": c for i, c in enumerate(first)}, "rest_keys": rest, "keys_size": size}).drop("keys")
    messages = calls.select(*at, F.explode("c.messages").alias("m")).select("block_number", "transaction_index", "trace_address", F.lower("m.from_address").alias("from_address"), F.lower("m.to_address").alias("to_address"), "m.payload", "m.order")
    update = blocks.select("writer_state_update.*").where("block_number is not null").select("block_number", "new_root", "old_root", "state_diff.*")
    slots = blocks.select(F.explode("writer_storage_diffs").alias("d")).select("d.block_number", "d.address", F.explode("d.storage_entries").alias("e")).select("block_number", "address", "e.key", "e.value")
    return {"events": event_table, "messages": messages, "state_updates": update, "storage_diffs": slots}


_TX = starknet.MODEL
STARKNET = RawModel(
    _TX, "number",
    (
        TableRule("blocks", "block", "", {"utcseconds": "timestamp"}, sources=_snake_sources(_TX, "block", l1GasPriceInFri="l1_gas_price.price_in_fri", l1GasPriceInWei="l1_gas_price.price_in_wei"), statistics="number"),
        TableRule(
            "transactions", "transaction", "writer_txs", {"int": "transactionIndex", "hexlong": "nonce", "texts": "calldata signature constructorCalldata paymasterData accountDeploymentData"},
            sources=_snake_sources(_TX, "transaction", transactionHash="receipt.transaction_hash", messageHash="receipt.message_hash", finalityStatus="receipt.finality_status"), drop="resourceBounds actualFee",
            hidden={**{f"resource_bounds_{g}_max_{m}": f"resource_bounds.{g}.max_{m}" for g in ("l1_gas", "l2_gas") for m in ("amount", "price_per_unit")}, "actual_fee_amount": "receipt.actual_fee.amount", "actual_fee_unit": "receipt.actual_fee.unit"},
            list_sizes={"calldata_size": "calldata", "signature_size": "signature", "constructor_calldata_size": "constructor_calldata"}, dictionary="contract_address sender_address type", statistics="_idx block_number transaction_index contract_address sender_address type nonce",
        ),
        TableRule(
            "traces", "trace", _CALL, {"int": "transactionIndex", "ints": "traceAddress", "texts": "calldata result"}, sources=_snake_sources(_TX, "trace"),
            list_sizes={"calldata_size": "calldata", "result_size": "result"}, dictionary="trace_type invocation_type call_type entry_point_type", statistics="_idx block_number transaction_index caller_address contract_address",
        ),
    ),
    "int", _starknet_more,
    f"{_CALL}[].block_number int;{_CALL}[].events {_INNER};{_CALL}[].messages {_MESSAGE};writer_events array<struct<block_number:int,transaction_index:int,event_index:int,from_address:string,keys:array<string>,data:array<string>>>;"
    "writer_state_update struct<block_number:int,new_root:string,old_root:string,state_diff:struct<deprecated_declared_classes:array<string>,declared_classes:array<struct<class_hash:string,compiled_class_hash:string>>,deployed_contracts:array<struct<address:string,class_hash:string>>,replaced_classes:array<struct<contract_address:string,class_hash:string>>,nonces:array<struct<contract_address:string,nonce:string>>>>;"
    "writer_storage_diffs array<struct<block_number:int,address:string,storage_entries:array<struct<key:string,value:string>>>>",
)

RAW = {r.model.name: r for r in (EVM, SOLANA, SUBSTRATE, TRON, FUEL, STARKNET)}
