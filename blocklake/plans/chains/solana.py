"""Solana: transactions, instructions, logs, balances, token balances, rewards."""

from blocklake.plans.chains.build import children, parents, same, scan, tree
from blocklake.plans.specs import ItemSpec, Model, TableSpec

TX = same("transaction_index")
AT = ("instruction_address", "instruction_address")

MODEL = Model(
    "solana",
    TableSpec("blocks"),
    {
        "transactions": TableSpec("transactions", ("transaction_index",), {"account_keys": "account_keys_size", "address_table_lookups": "address_table_lookups_size", "signatures": "signatures_size", "loaded_addresses": "loaded_addresses_size"}, ("fee_payer",)),
        "instructions": TableSpec("instructions", ("transaction_index", "instruction_address"), {"accounts": "accounts_size", "data": "data_size"}, ("d1", "program_id")),
        "logs": TableSpec("logs", ("transaction_index", "log_index"), {"message": "message_size"}, ("program_id", "kind")),
        "balances": TableSpec("balances", ("transaction_index", "account"), {}, ("account",)),
        "token_balances": TableSpec("token_balances", ("transaction_index", "account"), {}, ("post_program_id", "post_mint", "account")),
        "rewards": TableSpec("rewards", ("pubkey",), {}, ("pubkey",)),
    },
    {
        s.request: s
        for s in (
            scan("transactions", filters="feePayer"),
            scan("instructions", filters="programId d1 d2 d4 d8 " + " ".join(f"a{i}" for i in range(16)), equal={"isCommitted": "is_committed"}),
            scan("logs", filters="programId kind"),
            scan("balances", filters="account"),
            scan("tokenBalances", filters="account preMint postMint preOwner postOwner preProgramId postProgramId"),
            scan("rewards", filters="pubkey"),
        )
    },
    (
        ItemSpec("transactions", "transaction", "transactions", ("transactions",), parents("transaction", "instructions logs balances tokenBalances", *TX), ("transactionIndex",)),
        ItemSpec(
            "instructions", "instruction", "instructions", ("instructions",),
            children("instructions", "transactions", *TX) + tree("descendants", "innerInstructions", "instructions", TX, AT) + parents("instruction", "logs", *TX, AT) + children("transactionInstructions", "instructions balances tokenBalances", *TX),
            ("transactionIndex", "instructionAddress"),
        ),
        ItemSpec("logs", "log", "logs", ("logs",), children("logs", "transactions", *TX) + tree("at", "logs", "instructions", TX, AT), ("transactionIndex", "logIndex", "instructionAddress")),
        ItemSpec("balances", "balance", "balances", ("balances",), children("balances", "transactions", *TX) + children("transactionBalances", "instructions", *TX), ("transactionIndex", "account")),
        ItemSpec("tokenBalances", "tokenBalance", "token_balances", ("tokenBalances",), children("tokenBalances", "transactions", *TX) + children("transactionTokenBalances", "instructions", *TX), ("transactionIndex", "account")),
        ItemSpec("rewards", "reward", "rewards", ("rewards",), (), ("pubkey",)),
    ),
    {
        "block": tuple("number hash slot parentSlot parentHash timestamp".split()),
        "transaction": tuple("transactionIndex version accountKeys addressTableLookups numReadonlySignedAccounts numReadonlyUnsignedAccounts numRequiredSignatures recentBlockhash signatures err fee computeUnitsConsumed loadedAddresses feePayer hasDroppedLogMessages".split()),
        "instruction": tuple("transactionIndex instructionAddress programId accounts data d1 d2 d4 d8 error computeUnitsConsumed isCommitted hasDroppedLogMessages".split()),
        "log": tuple("transactionIndex logIndex instructionAddress programId kind message".split()),
        "balance": tuple("transactionIndex account pre post".split()),
        "tokenBalance": tuple("transactionIndex account preMint postMint preDecimals postDecimals preProgramId postProgramId preOwner postOwner preAmount postAmount".split()),
        "reward": tuple("pubkey lamports postBalance rewardType commission".split()),
    },
    renamed={"recent_blockhash": "recent_block_hash"},
    projections={
        "block": {"timestamp": "seconds"}, "transaction": {"version": "legacy", "fee": "text", "computeUnitsConsumed": "text", "err": "json"}, "instruction": {"accounts": "accounts", "computeUnitsConsumed": "text"},
        "balance": {"pre": "text", "post": "text"}, "tokenBalance": {"preAmount": "text", "postAmount": "text"}, "reward": {"lamports": "text", "postBalance": "text"},
    },
)
