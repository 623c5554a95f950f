"""Starknet: transactions, events, traces, messages, state updates, storage diffs."""

from blocklake.plans.chains.build import children, parents, same, scan, tree
from blocklake.plans.specs import ItemSpec, Model, TableSpec

TX = same("transaction_index")
AT = ("trace_address", "trace_address")

MODEL = Model(
    "starknet",
    TableSpec("blocks"),
    {
        "transactions": TableSpec("transactions", ("transaction_index",), {"calldata": "calldata_size", "signature": "signature_size", "constructor_calldata": "constructor_calldata_size"}, ("contract_address", "sender_address", "type", "nonce")),
        "events": TableSpec("events", ("transaction_index", "event_index"), {"keys": "keys_size", "data": "data_size"}, ("from_address", "key0")),
        "traces": TableSpec("traces", ("transaction_index", "trace_address"), {"calldata": "calldata_size", "result": "result_size"}, ("trace_type", "invocation_type", "caller_address", "contract_address", "call_type", "class_hash", "entry_point_selector", "entry_point_type")),
        "messages": TableSpec("messages", ("transaction_index", "trace_address", "order"), {"payload": "payload_size"}, ("from_address", "to_address")),
        "state_updates": TableSpec("state_updates", (), {"declared_classes": "declared_classes_size", "deployed_contracts": "deployed_contracts_size", "nonces": "nonces_size"}),
        "storage_diffs": TableSpec("storage_diffs", ("address", "key"), {}, ("address", "key")),
    },
    {
        s.request: s
        for s in (
            scan("transactions", filters="contractAddress senderAddress type", at_least={"firstNonce": "nonce"}, at_most={"lastNonce": "nonce"}),
            scan("events", filters="fromAddress key0 key1 key2 key3"),
            scan("traces", filters="callerAddress contractAddress callType classHash entryPointSelector entryPointType traceType invocationType"),
            scan("messages", filters="fromAddress toAddress"),
            scan("stateUpdates"),
            scan("storageDiffs", filters="address key"),
        )
    },
    (
        ItemSpec("transactions", "transaction", "transactions", ("transactions",), parents("transaction", "events traces", *TX), ("transactionIndex",)),
        ItemSpec("events", "event", "events", ("events",), children("events", "transactions", *TX) + tree("at", "events", "traces", TX, AT), ("transactionIndex", "eventIndex")),
        ItemSpec("traces", "trace", "traces", ("traces",), children("traces", "transactions", *TX), ("transactionIndex", "traceAddress")),
        ItemSpec("messages", "message", "messages", ("messages",), children("messages", "transactions", *TX) + tree("at", "messages", "traces", TX, AT), ("transactionIndex", "traceAddress", "order")),
        ItemSpec("state_updates", "stateUpdate", "state_updates", ("stateUpdates",), (), ()),
        ItemSpec("storage_diffs", "storageDiff", "storage_diffs", ("storageDiffs",), (), ("address", "key")),
    ),
    {
        "block": tuple("number hash parentHash status newRoot timestamp sequencerAddress starknetVersion l1GasPriceInFri l1GasPriceInWei".split()),
        "transaction": tuple("transactionIndex transactionHash contractAddress entryPointSelector calldata maxFee type senderAddress version signature nonce classHash compiledClassHash contractAddressSalt constructorCalldata resourceBounds tip paymasterData accountDeploymentData nonceDataAvailabilityMode feeDataAvailabilityMode messageHash actualFee finalityStatus".split()),
        "event": tuple("transactionIndex eventIndex fromAddress keys data traceAddress".split()),
        "trace": tuple("transactionIndex traceAddress traceType invocationType callerAddress contractAddress callType classHash entryPointSelector entryPointType revertReason calldata result".split()),
        "message": tuple("transactionIndex traceAddress order fromAddress toAddress payload".split()),
        "stateUpdate": tuple("newRoot oldRoot deprecatedDeclaredClasses declaredClasses deployedContracts replacedClasses nonces".split()),
        "storageDiff": tuple("address key value".split()),
    },
    projections={"block": {"timestamp": "seconds"}, "event": {"keys": "keys"}, "transaction": {"resourceBounds": "spread", "actualFee": "spread"}},
)
