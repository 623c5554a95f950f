"""Substrate: events, calls, extrinsics, with scans for tagged kinds of them."""

from blocklake.plans.chains.build import parents, same, scan, tree
from blocklake.plans.specs import ItemSpec, Model, TableSpec

CALLS = "calls ethereumTransactions"
EVENTS = "events evmLogs contractsEvents gearMessagesEnqueued gearUserMessagesSent reviveContractEmitted"
EXT = same("extrinsic_index")
TOPICS = "topic0 topic1 topic2 topic3"


def indexed(prefix: str, names: str) -> dict[str, str]:
    return {n: f"{prefix}_{n}" for n in names.split()}


MODEL = Model(
    "substrate",
    TableSpec("blocks", (), {"digest": "digest_size"}),
    {
        "events": TableSpec("events", ("index",), {"args": "args_size"}, ("name", "_evm_log_address", "_evm_log_topic0", "_contract_address", "_gear_program_id", "_revive_contract", "_revive_topic0")),
        "calls": TableSpec("calls", ("extrinsic_index", "address"), {"args": "args_size", "origin": "origin_size"}, ("name", "_ethereum_transact_to", "_ethereum_transact_sighash")),
        "extrinsics": TableSpec("extrinsics", ("index",), {"signature": "signature_size"}),
    },
    {
        s.request: s
        for s in (
            scan("events", filters="name"),
            scan("evmLogs", "events", f"address {TOPICS}", {"name": "EVM.Log"}, **indexed("_evm_log", f"address {TOPICS}")),
            scan("contractsEvents", "events", "contractAddress", {"name": "Contracts.ContractEmitted"}, contractAddress="_contract_address"),
            scan("gearMessagesEnqueued", "events", "programId", {"name": "Gear.UserMessageEnqueued"}, programId="_gear_program_id"),
            scan("gearUserMessagesSent", "events", "programId", {"name": "Gear.UserMessageSent"}, programId="_gear_program_id"),
            scan("reviveContractEmitted", "events", f"contract {TOPICS}", {"name": "Revive.ContractEmitted"}, **indexed("_revive", f"contract {TOPICS}")),
            scan("calls", filters="name"),
            scan("ethereumTransactions", "calls", "to sighash", {"name": "Ethereum.transact"}, **indexed("_ethereum_transact", "to sighash")),
        )
    },
    (
        ItemSpec("events", "event", "events", tuple(EVENTS.split()), tree("descendants", "events", CALLS, EXT, ("call_address", "address"), True), ("index", "extrinsicIndex", "callAddress")),
        ItemSpec(
            "calls", "call", "calls", tuple(CALLS.split()),
            tree("descendants", "subcalls", "calls", EXT, ("address", "address")) + tree("ancestors", "stack", CALLS, EXT, ("address", "address")) + tree("siblings", "siblings", CALLS, EXT, ("address", "address"))
            + parents("call", EVENTS, *EXT, ("address", "call_address")) + tree("ancestors", "stack", EVENTS, EXT, ("address", "call_address"), True),
            ("extrinsicIndex", "address"),
        ),
        ItemSpec("extrinsics", "extrinsic", "extrinsics", (), parents("extrinsic", f"{EVENTS} {CALLS}", ("index", "extrinsic_index")), ("index",)),
    ),
    {
        "block": tuple("number hash parentHash stateRoot extrinsicsRoot digest specName specVersion implName implVersion timestamp validator".split()),
        "extrinsic": tuple("index version signature fee tip error success hash".split()),
        "call": tuple("extrinsicIndex address name args origin error success".split()),
        "event": tuple("index name args phase extrinsicIndex callAddress topics".split()),
    },
    ("number", "hash", "parentHash"),
    projections={"block": {"timestamp": "millis", "digest": "json"}, "event": {"args": "json"}, "call": {"args": "json", "origin": "json", "error": "json"}, "extrinsic": {"fee": "text", "tip": "text", "signature": "json", "error": "json"}},
)
