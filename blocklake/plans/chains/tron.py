"""Tron: transactions, also by kind of contract, logs, internal transactions."""

from blocklake.plans.chains.build import children, parents, same, scan
from blocklake.plans.specs import ItemSpec, Model, TableSpec

SCANS = "transactions transferTransactions transferAssetTransactions triggerSmartContractTransactions"
TX = same("transaction_index")


def indexed(prefix: str, names: str) -> dict[str, str]:
    return {n: f"{prefix}_{n}" for n in names.split()}


MODEL = Model(
    "tron",
    TableSpec("blocks"),
    {
        "transactions": TableSpec("transactions", ("transaction_index",), {"raw_data_hex": "raw_data_hex_size", "parameter": "parameter_size"}, ("type", "_trigger_smart_contract_contract", "_trigger_smart_contract_sighash", "_transfer_contract_to", "_transfer_contract_owner")),
        "logs": TableSpec("logs", ("transaction_index", "log_index"), {"data": "data_size"}, ("topic0", "address")),
        "internal_transactions": TableSpec("internal_transactions", ("transaction_index", "internal_transaction_index"), {"extra": "extra_size"}, ("transfer_to_address", "caller_address")),
    },
    {
        s.request: s
        for s in (
            scan("transactions", filters="type"),
            scan("transferTransactions", "transactions", "owner to", {"type": "TransferContract"}, **indexed("_transfer_contract", "owner to")),
            scan("transferAssetTransactions", "transactions", "owner to asset", {"type": "TransferAssetContract"}, **indexed("_transfer_asset_contract", "owner to asset")),
            scan("triggerSmartContractTransactions", "transactions", "owner contract sighash", {"type": "TriggerSmartContract"}, **indexed("_trigger_smart_contract", "owner contract sighash")),
            scan("logs", filters="address topic0 topic1 topic2 topic3"),
            scan("internalTransactions", filters="caller transferTo", caller="caller_address", transferTo="transfer_to_address"),
        )
    },
    (
        ItemSpec("transactions", "transaction", "transactions", tuple(SCANS.split()), parents("transaction", "logs internalTransactions", *TX), ("transactionIndex",)),
        ItemSpec("logs", "log", "logs", ("logs",), children("logs", SCANS, *TX), ("transactionIndex", "logIndex")),
        ItemSpec("internalTransactions", "internalTransaction", "internal_transactions", ("internalTransactions",), children("internalTransactions", SCANS, *TX), ("transactionIndex", "internalTransactionIndex")),
    ),
    {
        "block": tuple("number hash parentHash txTrieRoot version timestamp witnessAddress witnessSignature".split()),
        "transaction": tuple("transactionIndex hash ret signature type parameter permissionId refBlockBytes refBlockHash feeLimit expiration timestamp rawDataHex fee contractResult contractAddress resMessage withdrawAmount unfreezeAmount withdrawExpireAmount cancelUnfreezeV2Amount result energyFee energyUsage energyUsageTotal netUsage netFee originEnergyUsage energyPenaltyTotal".split()),
        "log": tuple("transactionIndex logIndex address data topics".split()),
        "internalTransaction": tuple("transactionIndex internalTransactionIndex hash callerAddress transferToAddress callValueInfo note rejected extra".split()),
    },
    projections={
        "block": {"timestamp": "millis"}, "log": {"topics": "topics"}, "internalTransaction": {"callValueInfo": "json"},
        "transaction": {"ret": "json", "parameter": "json", "cancelUnfreezeV2Amount": "json", "timestamp": "millis", **dict.fromkeys("feeLimit fee withdrawAmount unfreezeAmount withdrawExpireAmount energyFee energyUsage energyUsageTotal netUsage netFee originEnergyUsage energyPenaltyTotal".split(), "text")},
    },
)
