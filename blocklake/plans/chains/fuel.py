"""Fuel: transactions, receipts, inputs, outputs."""

from blocklake.plans.chains.build import children, columns_to_names, parents, scan
from blocklake.plans.specs import ItemSpec, Model, TableSpec

OF_TX = ("transaction_index", "index")

MODEL = Model(
    "fuel",
    TableSpec("blocks"),
    {
        "transactions": TableSpec("transactions", ("index",), {"input_asset_ids": "input_asset_ids_size", "input_contracts": "input_contracts_size", "witnesses": "witnesses_size", "storage_slots": "storage_slots_size", "script_data": "script_data_size", "raw_payload": "raw_payload_size"}, ("type",)),
        "receipts": TableSpec("receipts", ("transaction_index", "index"), {"data": "data_size"}, ("receipt_type", "contract")),
        "inputs": TableSpec("inputs", ("transaction_index", "index"), {"coin_predicate": "coin_predicate_size", "coin_predicate_data": "coin_predicate_data_size", "message_data": "message_data_size", "message_predicate": "message_predicate_size", "message_predicate_data": "message_predicate_data_size"}, ("type", "coin_owner", "coin_asset_id")),
        "outputs": TableSpec("outputs", ("transaction_index", "index"), {}, ("type",)),
    },
    {
        s.request: s
        for s in (
            scan("transactions", filters="type"),
            scan("receipts", filters="type contract", type="receipt_type"),
            scan("inputs", filters="type coinOwner coinAssetId contractContract messageSender messageRecipient", contractContract="contract_contract_id"),
            scan("outputs", filters="type"),
        )
    },
    (
        ItemSpec("transactions", "transaction", "transactions", ("transactions",), parents("transaction", "receipts inputs outputs", ("index", "transaction_index")), ("index",)),
        ItemSpec("receipts", "receipt", "receipts", ("receipts",), children("receipts", "transactions", OF_TX), ("transactionIndex", "index")),
        ItemSpec("inputs", "input", "inputs", ("inputs",), children("inputs", "transactions", OF_TX), ("transactionIndex", "index", "type")),
        ItemSpec("outputs", "output", "outputs", ("outputs",), children("outputs", "transactions", OF_TX), ("transactionIndex", "index", "type")),
    ),
    {
        "block": tuple("number hash height daHeight transactionsRoot transactionsCount messageReceiptCount prevRoot time applicationHash eventInboxRoot consensusParametersVersion stateTransitionBytecodeVersion messageOutboxRoot".split()),
        "transaction": tuple("index hash inputAssetIds inputContracts inputContract policies scriptGasLimit maturity mintAmount mintAssetId mintGasPrice txPointer isScript isCreate isMint isUpgrade isUpload type outputContract witnesses receiptsRoot status script scriptData bytecodeWitnessIndex bytecodeRoot salt storageSlots rawPayload subsectionIndex subsectionsNumber proofSet upgradePurpose".split()),
        "receipt": tuple("index transactionIndex contract pc is to toAddress amount assetId gas param1 param2 val ptr digest reason ra rb rc rd len receiptType result gasUsed data sender recipient nonce contractId subId".split()),
        "input": tuple("type index transactionIndex coinUtxoId coinOwner coinAmount coinAssetId coinTxPointer coinWitnessIndex coinPredicateGasUsed coinPredicate coinPredicateData contractUtxoId contractBalanceRoot contractStateRoot contractTxPointer contractContractId messageSender messageRecipient messageAmount messageNonce messageWitnessIndex messagePredicateGasUsed messageData messagePredicate messagePredicateData".split()),
        "output": tuple("type index transactionIndex coinTo coinAmount coinAssetId contractInputIndex contractBalanceRoot contractStateRoot changeTo changeAmount changeAssetId variableTo variableAmount variableAssetId contractCreatedContract contractCreatedStateRoot".split()),
    },
    renamed={"height": "number"},
    projections={
        "block": {"time": "text", "height": "text", "daHeight": "text", "transactionsCount": "text", "messageReceiptCount": "text"},
        "transaction": {
            **dict.fromkeys("scriptGasLimit maturity mintAmount mintGasPrice".split(), "text"), "status": "json", "upgradePurpose": "json",
            "policies": {"tip": "tip:text", "witness_limit": "witnessLimit:text", "maturity": "maturity", "max_fee": "maxFee:text"},
            "inputContract": columns_to_names("utxo_id balance_root state_root tx_pointer contract_id"), "outputContract": columns_to_names("input_index balance_root state_root"),
        },
        "receipt": dict.fromkeys("pc is amount gas param1 param2 val ptr reason ra rb rc rd len result gasUsed".split(), "text"),
        "input": {"*": "variant"}, "output": {"*": "variant"},
    },
)
