"""EVM chains: transactions, logs, traces, state diffs."""

from blocklake.plans.chains.build import children, parents, same, scan, tree
from blocklake.plans.specs import ItemSpec, Model, TableSpec

TX = same("transaction_index")
TRACE = ("trace_address", "trace_address")

MODEL = Model(
    "eth",
    TableSpec("blocks", (), {"logs_bloom": 512, "extra_data": "extra_data_size"}),
    {
        "transactions": TableSpec("transactions", ("transaction_index",), {"input": "input_size"}, ("sighash", "to", "from")),
        "logs": TableSpec("logs", ("transaction_index", "log_index"), {"data": "data_size", "topics": 128}, ("topic0", "address")),
        "traces": TableSpec("traces", ("transaction_index", "trace_address"), {"create_init": "create_init_size", "create_result_code": "create_result_code_size", "call_input": "call_input_size", "call_result_output": "call_result_output_size"}, ("type", "create_from", "call_sighash", "call_to", "call_from")),
        "statediffs": TableSpec("statediffs", ("transaction_index", "address", "key"), {"prev": "prev_size", "next": "next_size"}),
    },
    {
        s.request: s
        for s in (
            scan("transactions", filters="to from sighash type", at_least={"firstNonce": "nonce"}, at_most={"lastNonce": "nonce"}),
            scan("logs", filters="address topic0 topic1 topic2 topic3"),
            scan("traces", filters="type createFrom callFrom callTo callSighash suicideRefundAddress createResultAddress rewardAuthor"),
            scan("stateDiffs", "statediffs", "address key kind"),
        )
    },
    (
        ItemSpec("transactions", "transaction", "transactions", ("transactions",), parents("transaction", "logs traces stateDiffs", *TX), ("transactionIndex",)),
        ItemSpec("logs", "log", "logs", ("logs",), children("logs", "transactions", *TX) + children("transactionLogs", "logs traces", *TX), ("logIndex", "transactionIndex")),
        ItemSpec("traces", "trace", "traces", ("traces",), children("traces", "transactions", *TX) + children("transactionTraces", "logs", *TX) + tree("descendants", "subtraces", "traces", TX, TRACE) + tree("ancestors", "parents", "traces", TX, TRACE), ("transactionIndex", "traceAddress", "type")),
        ItemSpec("stateDiffs", "stateDiff", "statediffs", ("stateDiffs",), children("stateDiffs", "transactions", *TX), ("transactionIndex", "address", "key", "kind")),
    ),
    {
        "block": tuple("number hash parentHash timestamp transactionsRoot receiptsRoot stateRoot logsBloom sha3Uncles extraData miner nonce mixHash size gasLimit gasUsed difficulty totalDifficulty baseFeePerGas l1BlockNumber blobGasUsed excessBlobGas".split()),
        "transaction": tuple("transactionIndex hash nonce from to input value gas gasPrice maxFeePerGas maxPriorityFeePerGas v r s yParity chainId sighash contractAddress gasUsed cumulativeGasUsed effectiveGasPrice type status maxFeePerBlobGas blobVersionedHashes l1Fee l1FeeScalar l1GasPrice l1GasUsed l1BlobBaseFee l1BlobBaseFeeScalar l1BaseFeeScalar".split()),
        "log": tuple("logIndex transactionIndex transactionHash address data topics".split()),
        "trace": tuple("traceAddress subtraces transactionIndex type error revertReason createFrom createValue createGas createInit createResultGasUsed createResultCode createResultAddress callFrom callTo callValue callGas callInput callSighash callType callResultGasUsed callResultOutput suicideAddress suicideRefundAddress suicideBalance rewardAuthor rewardValue rewardType".split()),
        "stateDiff": tuple("transactionIndex address key kind prev next".split()),
    },
    ("number", "hash", "parentHash"),
    projections={"block": {"timestamp": "seconds"}, "transaction": {"chainId": "safe_integer"}, "log": {"topics": "topics"}, "trace": {"*": "trace"}},
)
