"""Raw nested blocks to relational tables. Child arrays are exploded in the JVM; only recursive call frames need Python."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blocklake.functions.codecs import base58_bytes
from blocklake.functions.project import byte_size


def flatten_blocks(raw: DataFrame, children: dict[str, str], number: str = "number") -> dict[str, DataFrame]:
    """The block table and one table for each child array: ``children`` maps a table's name to the array's field.

    Every row gets its block's height and its place (``pos``) in the array; struct members become columns.
    """
    arrays = set(children.values())
    out = {"blocks": raw.select(*[c for c in raw.columns if c not in arrays])}
    for table, field in children.items():
        rows = raw.select(F.col(number).alias("block_number"), F.posexplode(field).alias("pos", "c"))
        out[table] = rows.select("block_number", "pos", "c.*")
    return out


def _digits(c: Column) -> Column:
    """The digits of a 0x quantity that count; one zero for zero."""
    return F.regexp_replace(c, "^0[xX]0*(?=.)", "")


def _fails(c: Column, bits: int) -> Column:
    return F.raise_error(F.concat(F.lit("quantity "), c, F.lit(f" has more than {bits} bits")))


def hex_to_int(c: Column) -> Column:
    """0x quantity of up to 63 bits; null stays null, a longer one stops the job (it stays text, or is a decimal)."""
    digits = _digits(c)
    value = F.conv(F.right(digits, F.lit(16)), 16, 10).cast("decimal(20,0)")
    fits = (F.length(digits) <= 16) & (value <= F.lit((1 << 63) - 1).cast("decimal(20,0)"))
    return F.when(c.isNull(), F.lit(None)).when(fits, value).otherwise(_fails(c, 63)).cast("long")


def hex_to_decimal(c: Column) -> Column:
    """0x quantity of up to 124 bits as ``decimal(38,0)``; null stays null, a longer one stops the job."""
    digits = F.lpad(_digits(c), 32, "0")
    part = lambda at, n: F.conv(F.substring(digits, at, n), 16, 10).cast("decimal(19,0)")
    times = lambda n: F.lit(str(16**n)).cast("decimal(38,0)")
    value = part(2, 1) * times(30) + part(3, 15) * times(15) + part(18, 15)
    return F.when(c.isNull(), F.lit(None)).when(F.length(_digits(c)) <= 31, value.cast("decimal(38,0)")).otherwise(_fails(c, 124).cast("decimal(38,0)"))


def text_to_int(c: Column) -> Column:
    return F.try_to_number(c, F.lit("S9999999999999999999")).cast("long")


def convert_quantities(df: DataFrame, hexes: list[str] = (), texts: list[str] = (), wide: list[str] = ()) -> DataFrame:
    """``hexes`` and ``texts`` become longs; ``wide``: 0x quantities that may have more than 63 bits, as ``decimal(38,0)``."""
    return df.withColumns({**{c: hex_to_int(F.col(c)) for c in hexes}, **{c: text_to_int(F.col(c)) for c in texts}, **{c: hex_to_decimal(F.col(c)) for c in wide}})


def sighash(data: Column, length: int = 10) -> Column:
    """The first ``length`` signs of call data that has as many."""
    return F.when(F.length(data) >= length, F.substring(data, 1, length))


def split_list(values: Column, k: int) -> tuple[list[Column], Column]:
    """The first ``k`` members as columns (null where there are fewer), and the rest, or null if none is left."""
    return [F.get(values, F.lit(i)) for i in range(k)], F.when(F.size(values) > k, F.slice(values, k + 1, 1 << 30))


def event_index(df: DataFrame, tx: str, position: str) -> DataFrame:
    """Counts a transaction's events from 0 in order of arrival."""
    return df.withColumn("event_index", F.row_number().over(Window.partitionBy(tx).orderBy(position)) - 1)


def add_sizes(df: DataFrame, columns: list[str], sort: list[str], per: str) -> DataFrame:
    """``<column>_size`` in bytes, and ``_idx``, a row's place among those of ``per`` in storage order."""
    order = Window.partitionBy(per).orderBy(*[F.col(c).asc_nulls_last() for c in sort])
    return df.withColumns({f"{c}_size": byte_size(F.col(c)) for c in columns}).withColumn("_idx", F.row_number().over(order) - 1)


def discriminators(df: DataFrame, data: str = "data") -> DataFrame:
    """``d1, d2, d4, d8``: hex of the first bytes of base58 data; shorter data gives shorter hex."""
    raw = df.withColumn("_raw", base58_bytes(F.col(data)))
    hexed = lambda n: F.concat(F.lit("0x"), F.lower(F.hex(F.substring(F.col("_raw"), 1, n))))
    return raw.withColumns({f"d{n}": hexed(n) for n in (1, 2, 4, 8)}).drop("_raw")


# call frames


#: Frame types of each kind of trace.
FRAME_KINDS = {
    "CALL": "call", "CALLCODE": "call", "STATICCALL": "call", "DELEGATECALL": "call", "delegateCall": "call", "INVALID": "call", "Call": "call", "call": "call",
    "CREATE": "create", "CREATE2": "create", "Create": "create", "create": "create", "SELFDESTRUCT": "suicide",
}
FRAMES = "trace_address array<int>, subtraces int, type string, call_type string, `from` string, `to` string, value string, gas string, gas_used string, input string, output string, error string, revert_reason string"


def walk_frames(frame: dict) -> Iterator[tuple]:
    """Pre-order walk of nested frames. A stack, not recursion: calls may be nested a thousand deep."""
    stack: list[tuple[list[int], dict]] = [([], frame)]
    while stack:
        at, f = stack.pop()
        kind = f.get("type")
        children = [c for c in f.get("calls") or [] if c.get("type") != "STOP"]
        if kind != "STOP":
            if kind not in FRAME_KINDS:
                raise ValueError(f"unknown frame type {kind}")
            yield (at, len(children), FRAME_KINDS[kind], kind.lower() if FRAME_KINDS[kind] == "call" else None, f.get("from"), f.get("to"), f.get("value"), f.get("gas"), f.get("gasUsed"), f.get("input"), f.get("output"), f.get("error"), f.get("revertReason"))
        stack += [([*at, i], c) for i, c in reversed(list(enumerate(children)))]


def _walked(df: DataFrame, key: tuple[str, ...], source: str, walk, schema: str) -> DataFrame:
    """``key`` and the rows that ``walk`` makes of each JSON text: batches go to Python and back as Arrow, null texts give none."""
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    own = T.StructType.fromDDL(schema)
    kinds = to_arrow_schema(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(len(key)).to_pylist()):
                for row in walk(json.loads(text)) if text is not None else ():
                    at.append(i)
                    rows.append(row)
            at = pa.array(at, pa.int64())
            columns = [pa.array(c, kinds.field(k).type) for k, c in enumerate(zip(*rows, strict=True) if rows else [[]] * len(own))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(len(key))), *columns], [*key, *own.names])

    rows = df.select(*key, F.col(source).alias("source"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *own.fields]))


def flatten_call_frames(df: DataFrame, frame: str = "frame", key: tuple[str, ...] = ("block_number", "transaction_index")) -> DataFrame:
    """Rows ``key`` and JSON of a nested frame to a row a call, with ``trace_address`` and ``subtraces``."""
    return _walked(df, key, frame, walk_frames, FRAMES)


INVOCATIONS = "invocation_type string, trace_address array<int>, call string, n_events int, first_event int"


def walk_invocations(trace: dict) -> Iterator[tuple]:
    """Calls of all invocations in pre-order."""
    calls, events = 0, 0
    for name in ("validate", "constructor", "execute", "fee_transfer"):  # fixed names of the invocations, in their order
        root = trace.get(f"{name}_invocation")
        stack = [([], root)] if root else []
        while stack:
            parent, call = stack.pop()
            at = [*parent, calls]
            calls += 1
            n = len(call.get("events") or [])
            yield (name, at, json.dumps({k: v for k, v in call.items() if k != "calls"}), n, events)
            events += n
            stack += [(at, c) for c in reversed(call.get("calls") or [])]


def unwrap_invocations(df: DataFrame, trace: str = "trace", key: tuple[str, ...] = ("block_number", "transaction_index")) -> DataFrame:
    """A call tree of several invocations to a row a call: ``invocation_type, trace_address, call, n_events, first_event``.

    The last part of an address counts all calls of the transaction, and events are numbered on through invocations: each
    starts at the greatest number before it plus one.
    """
    return _walked(df, key, trace, walk_invocations, INVOCATIONS)


def flatten_parity_traces(df: DataFrame, traces: str = "traces") -> DataFrame:
    """Flat trace records: a column group a type, null for rows of other types. ``traces`` are structs with action and result."""
    t = df.select("block_number", F.explode(traces).alias("t"))
    own = lambda kind, c: F.when(F.col("t.type") == kind, F.col(c))
    columns = {
        "transaction_index": F.col("t.transactionPosition"), "trace_address": F.col("t.traceAddress"), "subtraces": F.col("t.subtraces"), "type": F.col("t.type"), "error": F.col("t.error"),
        "create_from": own("create", "t.action.from"), "create_value": own("create", "t.action.value"), "create_gas": own("create", "t.action.gas"), "create_init": own("create", "t.action.init"),
        "create_result_address": own("create", "t.result.address"), "create_result_code": own("create", "t.result.code"), "create_result_gas_used": own("create", "t.result.gasUsed"),
        "call_from": own("call", "t.action.from"), "call_to": own("call", "t.action.to"), "call_value": own("call", "t.action.value"), "call_gas": own("call", "t.action.gas"), "call_input": own("call", "t.action.input"),
        "call_sighash": own("call", "t.action.input"), "call_result_output": own("call", "t.result.output"), "call_result_gas_used": own("call", "t.result.gasUsed"),
        "suicide_address": own("suicide", "t.action.address"), "suicide_refund_address": own("suicide", "t.action.refundAddress"), "suicide_balance": own("suicide", "t.action.balance"),
        "reward_author": own("reward", "t.action.author"), "reward_value": own("reward", "t.action.value"), "reward_type": own("reward", "t.action.rewardType"),
    }
    columns["call_sighash"] = sighash(columns["call_sighash"])
    return t.select("block_number", *[c.alias(k) for k, c in columns.items()])


# state


def prestate_diff(pre: DataFrame, post: DataFrame) -> DataFrame:
    """``key, kind, prev, next`` from rows ``block_number, transaction_index, address, key, value`` before and after.

    ``+`` came, ``-`` went, ``*`` changed. Balance, code and nonce that are only there before have not changed, since what is
    after holds changed ones alone; storage slots that are only there before were set to zero.
    """
    key = ["block_number", "transaction_index", "address", "key"]
    a, b = pre.withColumnRenamed("value", "prev"), post.withColumnRenamed("value", "next")
    met = a.join(b, key, "full_outer")
    known = F.col("key").isin("balance", "code", "nonce")
    kept = met.where(~(known & F.col("next").isNull()) & ~F.col("prev").eqNullSafe(F.col("next")))
    kind = F.when(F.col("prev").isNull(), "+").when(F.col("next").isNull(), "-").otherwise("*")
    return kept.select(*key, kind.alias("kind"), "prev", "next")


def parity_state_diff(df: DataFrame, diff: str = "diff") -> DataFrame:
    """Rows ``block_number, transaction_index, address, key, diff`` with JSON diffs: "=" is nothing, +, - and * as they say."""
    v = F.col(diff)
    m = F.from_json(v, "map<string,string>")
    got = lambda sign, path=None: F.get_json_object(F.try_element_at(m, F.lit(sign)), path) if path else F.try_element_at(m, F.lit(sign))
    kind = F.when(got("+").isNotNull(), "+").when(got("-").isNotNull(), "-").when(got("*").isNotNull(), "*")
    prev = F.coalesce(got("-"), got("*", "$.from"))
    nxt = F.coalesce(got("+"), got("*", "$.to"))
    return df.where(F.trim(v) != '"="').select("block_number", "transaction_index", "address", "key", kind.alias("kind"), prev.alias("prev"), nxt.alias("next")).where("kind is not null")


def explode_state_updates(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State updates, a row a block, and storage diffs, a row a slot, from ``state_update`` structs with ``storage_diffs``."""
    update = raw.select(F.col("number").alias("block_number"), "state_update")
    slots = update.select("block_number", F.explode("state_update.storage_diffs").alias("d")).select("block_number", "d.address", F.explode("d.storage_entries").alias("e"))
    return update.select("block_number", F.col("state_update").dropFields("storage_diffs").alias("u")).select("block_number", "u.*"), slots.select("block_number", "address", "e.key", "e.value")


# receipts, logs, rules


def status_from_traces(frame: Column, trace: Column) -> Column:
    """``status, contract_address`` of a transaction without a receipt, from its top call frame, else from its top trace.

    ``frame``: a struct of type, error and to; ``trace``: a struct of type, error and address. Neither tells nothing: null.
    A frame of type INVALID has failed like one with an error; what a call that went well created has an address.
    """
    ok = frame["error"].isNull() & (frame["type"] != "INVALID")
    told = lambda ok, created, address: F.struct(ok.cast("int").alias("status"), F.when(ok & created, address).alias("contract_address"))
    by_trace = told(trace["error"].isNull(), trace["type"] == "create", trace["address"])
    return F.when(frame.isNotNull(), told(ok, frame["type"].isin("CREATE", "CREATE2"), frame["to"])).when(trace.isNotNull(), by_trace)


#: Members of a receipt that become columns as they are, and those that become numbers.
RECEIPT_TEXTS = {"gasUsed": "gas_used", "cumulativeGasUsed": "cumulative_gas_used", "effectiveGasPrice": "effective_gas_price", "l1Fee": "l1_fee", "l1FeeScalar": "l1_fee_scalar", "l1GasPrice": "l1_gas_price", "l1GasUsed": "l1_gas_used", "l1BlobBaseFee": "l1_blob_base_fee"}
RECEIPT_NUMBERS = {"type": "type", "l1BlobBaseFeeScalar": "l1_blob_base_fee_scalar", "l1BaseFeeScalar": "l1_base_fee_scalar"}


def with_receipts(transactions: DataFrame, receipts: DataFrame) -> DataFrame:
    """Transactions (``hash, block_hash``, and ``frame``, ``trace`` as of :func:`status_from_traces`) with the columns of their receipts.

    ``receipts``: rows ``transactionHash, blockHash, status, contractAddress`` and what else of a receipt there is, as texts. A
    receipt of another block with the same transaction is not its receipt. Without one, status and address come from traces.
    """
    have = set(receipts.columns)
    member = lambda name: F.col(name) if name in have else F.lit(None).cast("string")
    columns = {**{c: member(f) for f, c in RECEIPT_TEXTS.items()}, **{c: hex_to_int(member(f)).cast("int") for f, c in RECEIPT_NUMBERS.items()}}
    told = F.struct(hex_to_int(F.col("status")).cast("int").alias("status"), member("contractAddress").alias("contract_address"))
    own = receipts.select(F.col("transactionHash").alias("hash"), F.col("blockHash").alias("block_hash"), F.struct(*[c.alias(k) for k, c in columns.items()]).alias("_receipt"), told.alias("_told"))
    rows = transactions.drop(*columns, "status", "contract_address").join(own, ["hash", "block_hash"], "left")
    rows = rows.withColumn("_told", F.coalesce("_told", status_from_traces(F.col("frame"), F.col("trace"))))
    kept = [c for c in rows.columns if c not in ("_receipt", "_told", "frame", "trace")]
    return rows.select(*kept, "_receipt.*", "_told.status", "_told.contract_address")


def choose_logs(block_logs: Column, receipt_logs: Column) -> Column:
    """Logs of the block if they are there, else those of its receipts, with addresses in small letters."""
    return F.transform(F.coalesce(block_logs, F.flatten(receipt_logs)), lambda x: x.withField("address", F.lower(x["address"])))


def contract_parameters(parameter: Column, kind: Column) -> dict[str, Column]:
    """Index columns of a contract call's JSON parameter, by type; null for other types."""
    of = lambda t, path: F.when(kind == t, F.get_json_object(parameter, path))
    return {
        "_transfer_contract_owner": of("TransferContract", "$.value.owner_address"), "_transfer_contract_to": of("TransferContract", "$.value.to_address"),
        "_transfer_asset_contract_owner": of("TransferAssetContract", "$.value.owner_address"), "_transfer_asset_contract_to": of("TransferAssetContract", "$.value.to_address"), "_transfer_asset_contract_asset": of("TransferAssetContract", "$.value.asset_name"),
        "_trigger_smart_contract_owner": of("TriggerSmartContract", "$.value.owner_address"), "_trigger_smart_contract_contract": of("TriggerSmartContract", "$.value.contract_address"),
        "_trigger_smart_contract_sighash": sighash(of("TriggerSmartContract", "$.value.data"), 8),
    }


def hidden_index(df: DataFrame, fields: dict[str, str], source: str = "args") -> DataFrame:
    """Index columns from members of JSON arguments: ``fields`` maps a column to its path."""
    return df.withColumns({c: F.get_json_object(source, path) for c, path in fields.items()})


def unpack_union(value: Column, tag: Column, variants: dict[str, dict[str, str]]) -> dict[str, Column]:
    """A nullable column for each member of each variant; a tag that is none of them stops the job."""
    known = F.when(tag.isin(*variants) | tag.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unknown type "), tag)).cast("boolean"))
    return {column: F.when(known & (tag == name), F.get_json_object(value, path)) for name, members in variants.items() for column, path in members.items()}


def normalise_struct(value: Column, numbers: tuple[str, ...], texts: tuple[str, ...], rename: dict[str, str] | None = None) -> Column:
    """A JSON object as a struct with snake-case members, some of them numbers."""
    from blocklake.functions.project import snake

    name = lambda k: (rename or {}).get(k, snake(k))
    members = [F.get_json_object(value, f"$.{k}").cast("long").alias(name(k)) for k in numbers] + [F.get_json_object(value, f"$.{k}").alias(name(k)) for k in texts]
    return F.when(value.isNotNull(), F.struct(*members))


def trace_children(traces: DataFrame, child: str, reverted: str = "revert_reason") -> DataFrame:
    """Events or messages of calls that were not reverted, a row each with its place."""
    return traces.where(F.col(reverted).isNull()).select("block_number", "transaction_index", "trace_address", F.posexplode(child).alias("pos", "c")).select("block_number", "transaction_index", "trace_address", "pos", "c.*")


def prefer_traced(flat: DataFrame, traced: DataFrame, key: list[str] = ["block_number"]) -> DataFrame:  # noqa: B006
    """Rows from traces; for blocks without any, the flat ones."""
    return traced.unionByName(flat.join(traced.select(*key).distinct(), key, "left_anti"), allowMissingColumns=True)


def zip_traces(df: DataFrame, transactions: str = "transactions", traces: str = "traces", special=None) -> tuple[DataFrame, DataFrame]:
    """``block_number, transaction, trace`` by place, after special transactions are left out; and blocks whose numbers differ."""
    kept = F.filter(transactions, lambda t: ~special(t)) if special else F.col(transactions)
    rows = df.select("block_number", kept.alias("t"), F.col(traces).alias("r"))
    same = rows.where(F.size("t") == F.size("r")).select("block_number", F.explode(F.arrays_zip("t", "r")).alias("p"))
    odd = rows.where(F.size("t") != F.size("r")).select("block_number", F.size("t").alias("transactions"), F.size("r").alias("traces"))
    return same.select("block_number", F.col("p.t").alias("transaction"), F.col("p.r").alias("trace")), odd


def align_traces(transactions: DataFrame, traces: DataFrame) -> DataFrame:
    """``block_number, transaction_index, trace_index``: traces in order that have a transaction's from, to and value.

    A trace without one is passed over. Sequential within a block, which is a small group.
    """
    both = transactions.select("block_number", F.lit(0).alias("side"), F.col("transaction_index").cast("int").alias("i"), "from", "to", "value").unionByName(traces.select("block_number", F.lit(1).alias("side"), F.col("trace_index").cast("int").alias("i"), "from", "to", "value"))

    def align(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["side", "i"])
        same = ["from", "to", "value"]
        txs, out, t = pdf[pdf.side == 0].reset_index(drop=True), [], 0
        for row in pdf[pdf.side == 1].itertuples(index=False):
            if t < len(txs) and all(getattr(row, c) == txs.at[t, c] if c != "from" else row[pdf.columns.get_loc("from")] == txs.at[t, "from"] for c in same):
                out.append((row.block_number, int(txs.at[t, "i"]), row.i))
                t += 1
        return pd.DataFrame(out, columns=["block_number", "transaction_index", "trace_index"])

    return both.groupBy("block_number").applyInPandas(align, "block_number long, transaction_index int, trace_index int")


RULES = "chain string, from_block long, to_block long, tx_hash string, action string, value string"
#: Rules are written by people; more than so many of one chain are taken for a mistake.
MOST_RULES = 10_000
ZERO_ADDRESS = "0x" + 40 * "0"


def apply_rules(transactions: DataFrame, rules: DataFrame, chain: str) -> DataFrame:
    """Corrections as data: ``rules`` has ``chain, from_block, to_block, tx_hash, action, value``; one scan, with no join.

    A null hash stands for all transactions of the blocks; an action whose columns ``transactions`` lacks matches nothing. Actions:

    * ``drop``; ``drop_type``: those of type ``value``; ``drop_zero_address``: those from and to the zero address;
    * ``drop_duplicated``: those whose receipt (``receipt_block_hash``) is of another block than their own (``block_hash``);
    * ``slice``: those with an index below ``value``;
    * ``set_type``: all get type ``value``; ``fill_type``: those without a type get ``value``; ``fill_type_by``: those without a type
      get 0x2 if the column ``value`` is not null, else 0x0.
    """
    mine = rules.where(F.col("chain") == chain).limit(MOST_RULES + 1).collect()
    if len(mine) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules for {chain}")
    have = {c.lower() for c in transactions.columns}
    col = lambda c: F.col(f"`{c}`") if c.lower() in have else F.lit(None).cast("string")

    def holds(r) -> Column:
        of_block = F.col("block_number").between(r["from_block"], r["to_block"])
        return of_block if r["tx_hash"] is None else of_block & (col("hash") == r["tx_hash"])

    dropped, kind = F.lit(False), col("type").cast("string")
    for r in mine:
        action, value = r["action"], r["value"]
        if action.startswith("drop") or action == "slice":
            test = {
                "drop": F.lit(True), "drop_type": col("type") == value, "drop_zero_address": (col("from") == ZERO_ADDRESS) & (col("to") == ZERO_ADDRESS),
                "drop_duplicated": col("receipt_block_hash") != col("block_hash"), "slice": col("transaction_index").cast("long") < F.lit(value).try_cast("long"),
            }[action]
            dropped = dropped | (holds(r) & F.coalesce(test, F.lit(False)))
        else:
            new = {"set_type": F.lit(value), "fill_type": F.coalesce(kind, F.lit(value)), "fill_type_by": F.coalesce(kind, F.when(col(value or "").isNotNull(), F.lit("0x2")).otherwise(F.lit("0x0")))}[action]
            kind = F.when(holds(r), new).otherwise(kind)
    kept = transactions.where(~F.coalesce(dropped, F.lit(False)))
    return kept.withColumn("type", kind) if "type" in have else kept
