"""From a request to blocks: one lazy plan over all chunks.

``query(model, tables, request)`` checks the request, scans keys, follows relations, semi-joins each item table once, cuts
by budget on narrow frames, projects, and puts blocks together. Tables come as a function from name to DataFrame, so that
only those that are asked for are opened.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklake.functions import project as P
from blocklake.operators import assemble, budget, predicates, ranges, relations
from blocklake.plans.specs import ItemSpec, Model, RelSpec, ScanSpec
from blocklake.sources.shared import stored

MAX_REQUESTS = 100


class InvalidQuery(ValueError):
    """A request that no plan is made for."""


def validate(model: Model, request: dict) -> None:
    """Raises InvalidQuery for unknown names, wrong types, empty ranges, and too many item requests."""

    def need(ok: bool, what: str) -> None:
        if not ok:
            raise InvalidQuery(what)

    first, last = request.get("fromBlock", 0), request.get("toBlock")
    need(isinstance(first, int) and first >= 0, "fromBlock is a height")
    need(last is None or isinstance(last, int) and last >= 0, "toBlock is a height")
    need(last is None or last >= first, "toBlock is not less than fromBlock")
    need(isinstance(request.get("includeAllBlocks", False), bool), "includeAllBlocks is true or false")
    need(request.get("type", model.name) == model.name, f"unknown type {request.get('type')}")
    for name in request:
        need(name in model.scans or name in ("type", "fromBlock", "toBlock", "includeAllBlocks", "fields"), f"unknown field {name}")
    total = 0
    for name, scan in model.scans.items():
        flags = {r.flag for item in model.items for r in item.relations if r.scan == name}
        requests = request.get(name) or []
        need(isinstance(requests, list), f"{name} is a list")
        total += len(requests)
        for r in requests:
            need(isinstance(r, dict), f"{name} has objects")
            for key, value in r.items():
                if key in scan.filters:
                    need(value is None or isinstance(value, list), f"{name}.{key} is a list")
                elif key in scan.at_least or key in scan.at_most:
                    need(value is None or isinstance(value, int), f"{name}.{key} is a number")
                else:
                    need(key in scan.equal or key in flags, f"unknown field {name}.{key}")
                    need(value is None or isinstance(value, bool), f"{name}.{key} is true or false")
    need(total <= MAX_REQUESTS, f"more than {MAX_REQUESTS} item requests")
    for entity, wanted in (request.get("fields") or {}).items():
        need(entity in model.fields, f"unknown entity {entity}")
        for f, on in wanted.items():
            need(f in model.fields[entity], f"unknown field {entity}.{f}")
            need(isinstance(on, bool), f"{entity}.{f} is true or false")


def _condition(scan: ScanSpec, r: dict) -> Column | None:
    parts = [predicates.field_in(c, r.get(n)) for n, c in scan.filters.items()]
    parts += [predicates.field_gte(c, r.get(n)) for n, c in scan.at_least.items()] + [predicates.field_lte(c, r.get(n)) for n, c in scan.at_most.items()]
    parts += [predicates.field_eq(c, r.get(n)) for n, c in scan.equal.items()] + [predicates.field_eq(c, v) for c, v in scan.fixed.items()]
    return predicates.all_of(parts)


def _related(items: DataFrame, keys: DataFrame, rel: RelSpec, item_key: list[str]) -> DataFrame:
    """Keys of the items that a relation adds for scanned rows."""
    on = list(rel.on)
    if rel.kind == "children":
        found = relations.join_children(items, keys, on)
    elif rel.kind == "at":
        found = relations.join_at(items, keys, on, rel.address)
    elif rel.kind == "siblings":
        found = relations.siblings(items, keys, on, rel.address)
    else:
        walk = relations.descendants if rel.kind == "descendants" else relations.ancestors
        found = walk(items, keys, on, rel.address, rel.include_self)
    return found.select("block_number", *item_key)


class ScannedKeys:
    """Keys that a request's scans find, by table: one pass over a table whatever number of scans and relations go by it.

    A row's ``mask`` has a bit for each scan that selects it, and for each scan with a relation flag. A table that is asked for once is
    scanned where it is needed; the keys of others are written to the shared folder when the plan is made, and read from there.
    """

    def __init__(self, model: Model, tables: Callable[[str], DataFrame], request: dict, limits: Column | None):
        self.model, self.tables, self.limits = model, tables, limits
        self.asked: dict[str, dict[tuple[str, str | None], Column | None]] = {}
        self.columns: dict[str, dict[str, None]] = {}
        self.made: dict[str, DataFrame] = {}
        for item in model.items:
            for name in item.scans:
                self._ask(name, None, request.get(name) or [], list(model.tables[item.table].key))
            for rel in item.relations:
                self._ask(rel.scan, rel.flag, [r for r in request.get(rel.scan) or [] if r.get(rel.flag)], _scan_columns(rel))

    def _ask(self, name: str, flag: str | None, requests: list[dict], columns: list[str]) -> None:
        scan = self.model.scans[name]
        if requests:  # all requests of one list are one filter
            self.asked.setdefault(scan.table, {})[name, flag] = predicates.any_of([_condition(scan, r) for r in requests])
            self.columns.setdefault(scan.table, {}).update(dict.fromkeys(columns))

    def has(self, name: str, flag: str | None) -> bool:
        return (name, flag) in self.asked.get(self.model.scans[name].table, {})

    def of(self, name: str, flag: str | None, columns: list[str]) -> DataFrame:
        """``block_number`` and columns of the rows that a scan finds, or those of its requests with a flag."""
        table = self.model.scans[name].table
        asked = self.asked[table]
        if len(asked) == 1:
            return predicates.scan(self.tables(table), [asked[name, flag]], columns, limits=self.limits)
        if table not in self.made:
            bits = [F.when(F.lit(True) if c is None else c, F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, c in enumerate(asked.values())]
            rows = predicates.where(predicates.where(self.tables(table), self.limits), predicates.any_of(list(asked.values())))
            self.made[table] = stored(rows.select("block_number", *self.columns[table], sum(bits[1:], bits[0]).alias("mask")), f"keys-{table}")
        bit = 1 << list(asked).index((name, flag))
        return self.made[table].where(F.col("mask").bitwiseAND(F.lit(bit).cast("long")) != 0).select("block_number", *columns)


def _scan_columns(rel: RelSpec) -> list[str]:
    """Columns of scanned rows that a relation goes by."""
    return list(dict.fromkeys([b for _, b in rel.on] + ([rel.address[1]] if rel.address else [])))


def selected(model: Model, item: ItemSpec, tables: Callable[[str], DataFrame], scanned: ScannedKeys, limits: Column | None) -> DataFrame | None:
    """The rows of an item table that a request asks for, or None if nothing in it does."""
    scans, flags = [n for n in item.scans if scanned.has(n, None)], [r for r in item.relations if scanned.has(r.scan, r.flag)]
    if not scans and not flags:  # the table is not even opened
        return None
    key = list(model.tables[item.table].key)
    rows = predicates.where(tables(item.table), limits)
    sources = [scanned.of(name, None, key) for name in scans]
    for rel in flags:
        keys = scanned.of(rel.scan, rel.flag, _scan_columns(rel))
        if rel.kind == "parent":
            keys = relations.ref_parent(keys, [b for _, b in rel.on], [a for a, _ in rel.on])
            own = [(a, a) for a, _ in rel.on]
            sources.append(relations.join_children(rows, keys, own).select("block_number", *key) if {a for a, _ in own} != set(key) else keys.select("block_number", *key))
        else:
            sources.append(_related(rows, keys, rel, key))
    return relations.select_items(rows, sources, key)


#: Members of each kind of trace, by the prefixes of their columns.
_TRACE_KINDS = ("create", "call", "suicide", "reward")


def _trace(fields: list[str]) -> Column:
    """A trace as JSON text: common fields as they are, those of the row's own type inside ``action`` and ``result``.

    Both are there only if fields of that type were asked for; members that are null are left out. An action without members is an
    empty object, a result without members is left out. Rows of other types have common fields alone.
    """
    kind = lambda f: next((k for k in _TRACE_KINDS if f.startswith(k)), None)
    common = [f for f in fields if kind(f) is None]
    members = lambda names, prefix: F.to_json(F.struct(*[F.col(P.snake(f)).alias(P.without_prefix(f, (prefix,))) for f in names])) if names else None
    head = F.to_json(F.struct(*[F.col(P.snake(f)).alias(f) for f in common]), {"ignoreNullFields": "false"})
    open_head = F.substring(head, F.lit(1), F.length(head) - 1)
    out = head
    for k in _TRACE_KINDS:
        action = members([f for f in fields if kind(f) == k and not f.startswith(f"{k}Result")], k)
        result = members([f for f in fields if f.startswith(f"{k}Result")], f"{k}Result")
        if action is None and result is None:
            continue
        parts = [open_head]
        if action is not None:
            parts += [F.lit(',"action":'), action]
        if result is not None:
            parts.append(F.when(result == "{}", F.lit("")).otherwise(F.concat(F.lit(',"result":'), result)))
        out = F.when(F.col("type") == k, F.concat(*parts, F.lit("}"))).otherwise(out)
    return out


#: Prefixes of variants, the longer of two that begin alike after the shorter one, as outputs have always been named.
_VARIANTS = ("coin", "contract", "message", "change", "variable")


def _variant(fields: list[str]) -> dict[str, Column]:
    """Fields of tagged unions without their variant's prefix: of several with one name the one that is not null."""
    groups: dict[str, list[Column]] = {}
    for f in fields:
        groups.setdefault(f if f in ("type", "index", "transactionIndex") else P.without_prefix(f, _VARIANTS), []).append(F.col(P.snake(f)).cast("string") if f.lower().endswith(("amount", "gasused")) else F.col(P.snake(f)))
    return {k: F.coalesce(*c) if len(c) > 1 else c[0] for k, c in groups.items()}


#: Fields that several columns make up: the columns, and the names that they have inside.
_SPREAD = {
    "resourceBounds": {f"resource_bounds_{P.snake(n)}": n for n in ("l1GasMaxAmount", "l1GasMaxPricePerUnit", "l2GasMaxAmount", "l2GasMaxPricePerUnit")},
    "actualFee": {"actual_fee_amount": "amount", "actual_fee_unit": "unit"},
}


def columns_of(field: str) -> list[str]:
    """The columns that a field is made of, each with its weight."""
    return list(_SPREAD[field]) if field in _SPREAD else [P.snake(field)]


def item_of(model: Model, entity: str, wanted: list[str], df: DataFrame) -> Column:
    """An item as it is put out: a struct of its fields, or an object whose members depend on the row's type."""
    if model.projections.get(entity, {}).get("*") == "trace":
        return P.embedded_json(_trace(wanted))
    return F.struct(*[c.alias(k) for k, c in fields_of(model, entity, wanted, df).items()])


def fields_of(model: Model, entity: str, wanted: list[str], df: DataFrame) -> dict[str, Column]:
    """Output fields of an entity as columns of its table."""
    rules, types = model.projections.get(entity, {}), dict(df.dtypes)
    if rules.get("*") == "variant":
        return _variant(wanted)
    out = {}
    for f in wanted:
        name = P.snake(f)
        name, rule = model.renamed.get(name, name), rules.get(f)
        if rule == "topics":
            out[f] = P.compact_list(*[F.col(f"topic{i}") for i in range(4)])
        elif rule == "accounts":
            out[f] = P.list_with_rest([F.col(f"a{i}") for i in range(16)], F.col("rest_accounts"))
        elif rule == "keys":
            out[f] = P.list_with_rest([F.col(f"key{i}") for i in range(4)], F.col("rest_keys"))
        elif rule == "spread":
            out[f] = P.struct_of({inner: F.col(c) for c, inner in _SPREAD[f].items()})
        elif isinstance(rule, dict):
            out[f] = P.rekeyed(F.col(name), {c: inner.removesuffix(":text") for c, inner in rule.items()}, tuple(c for c, inner in rule.items() if inner.endswith(":text")))
        else:
            c = F.col(name)
            apply = {"text": P.as_text, "json": P.embedded_json, "seconds": lambda c, k=types.get(name, ""): P.epoch_seconds(c, k), "millis": lambda c, k=types.get(name, ""): P.epoch_millis(c, k), "safe_integer": P.safe_integer, "legacy": P.version_json}
            out[f] = apply[rule](c) if rule else c
    return out


def query(model: Model, tables: Callable[[str], DataFrame], request: dict, limit: int | None = None, chunk: Callable[[Column], Column] | None = None, chunks: DataFrame | None = None) -> DataFrame:
    """``block_number, header`` and a list for each item that the request asks for.

    The first and last block of each chunk's part of the range are always there: ``chunks`` has ``first_block, last_block`` of the
    lake's chunks, or ``chunk`` makes chunks of heights; without both, the range is one. ``limit``: a budget of weights by which
    blocks are cut, within each chunk, or over the whole range.
    """
    validate(model, request)
    first, last = request.get("fromBlock", 0), request.get("toBlock")
    limits, asked = predicates.block_range(first, last), request.get("fields") or {}
    headers = predicates.where(tables("blocks"), predicates.block_range(first, last, "number"))
    scanned = ScannedKeys(model, tables, request, limits)
    rows = {item: found for item in model.items if (found := selected(model, item, tables, scanned, limits)) is not None}
    wanted = {item: P.selected_fields(item.mandatory, asked.get(item.entity, {})) for item in rows}
    header_fields = P.selected_fields(model.block_mandatory, asked.get("block", {}))
    if request.get("includeAllBlocks"):
        ends = budget.include_all(headers)
    elif chunks is not None:
        ends = budget.chunk_ends(chunks, first, last)
    else:
        ends = budget.boundary_blocks(headers.withColumn("chunk", chunk(F.col("number"))), per="chunk") if chunk else budget.boundary_blocks(headers)

    def weight(table, df: DataFrame, fields: list[str]) -> Column:
        have = set(df.columns)
        known = {c: w for c, w in table.weights.items() if not isinstance(w, str) or w in have}
        return budget.row_weight(known, [c for f in fields for c in columns_of(f)])

    if limit is None:
        kept = relations.union_keys([ends, *[df.select("block_number") for df in rows.values()]]).distinct()
    else:
        parts = [df.select("block_number", weight(model.tables[item.table], df, wanted[item]).alias("weight")) for item, df in rows.items()]
        sums = budget.header_weight(budget.block_weights(parts, ends), headers, weight(model.block, headers, header_fields))
        if chunks is not None:
            own = ranges.find_range(chunks.select(F.lit("").alias("dataset"), F.col("first_block").alias("beg"), F.col("last_block").alias("end")), sums.withColumn("dataset", F.lit("")).withColumnRenamed("block_number", "n"))
            kept = budget.budget_cut(own.select(F.col("n").alias("block_number"), "weight", F.col("beg").alias("chunk")), limit).select("block_number")
        elif chunk:
            kept = budget.budget_cut(sums.withColumn("chunk", chunk(F.col("block_number"))), limit).select("block_number")
        else:  # sums run by stretches of heights, a row a stretch puts them together
            kept = budget.budget_cut(sums.withColumn("chunk", F.floor(F.col("block_number") / budget.STRETCH)), limit, per=None).select("block_number")
    lists = {}
    for item, df in rows.items():
        key = list(model.tables[item.table].key)
        cut = df.join(kept, "block_number", "left_semi")
        lists[item.name] = assemble.collect_items(cut, key, item_of(model, item.entity, wanted[item], cut), item.name)
    shown = headers.join(kept.select(F.col("block_number").alias("number")), "number", "left_semi")
    header = F.struct(*[c.alias(k) for k, c in fields_of(model, "block", header_fields, headers).items()])
    return assemble.assemble_blocks(shown, lists, header)


def next_page(model: Model, tables: Callable[[str], DataFrame], request: dict, limit: int, chunks: DataFrame, page_bytes: int | None = None) -> tuple[DataFrame, int | None]:
    """One page of a request, as ``block_number, value``, and its last height: the next page's ``fromBlock`` is one more; None at the end.

    ``limit`` cuts blocks by weight within each chunk (see :func:`query`); the page ends where the first chunk is cut short, or, with
    ``page_bytes``, with the block at which its bytes exceed that. Page after page gives what one request without limits gives,
    but for the heights at ends of pages and chunks, which are always there. Two heights reach the driver.
    """
    found = stored(to_json(query(model, tables, request, limit, chunks=chunks)), "page")
    first, last = request.get("fromBlock", 0), request.get("toBlock")
    bounds = budget.chunk_ends(chunks, first, last).agg(F.max("block_number").alias("end")).first()["end"]
    if bounds is None:
        return found, None
    # a chunk is whole if the last height of its part of the range is there; as in a cut, that is the first to go
    parts = chunks.select(F.least("last_block", F.lit(last if last is not None else bounds)).cast("long").alias("e"), F.col("first_block").alias("b")).where(f"b <= {last if last is not None else bounds} AND e >= {first}")
    reached = ranges.find_range(parts.select(F.lit("").alias("dataset"), F.col("b").alias("beg"), F.col("e").alias("end")), found.select(F.lit("").alias("dataset"), F.col("block_number").alias("n")))
    ends = reached.groupBy("beg", "end").agg(F.max("n").alias("n"))
    cut = ends.where(F.col("n") < F.col("end")).agg(F.min("n").alias("n")).first()["n"]
    if page_bytes is not None:
        pages = budget.roll(found.withColumn("size", F.octet_length("value")), page_bytes, name="page")
        full = pages.where("page = 0").agg(F.max("block_number").alias("n")).first()["n"]
        cut = full if cut is None else cut if full is None else min(cut, full)
    if cut is None or cut >= bounds:
        return found, None
    return found.where(F.col("block_number") <= cut), cut


def to_json(blocks: DataFrame) -> DataFrame:
    """Each block as one JSON text, nulls kept, in a column ``value``."""
    names = [c for c in blocks.columns if c != "block_number"]
    return blocks.select("block_number", P.json_object(F.struct(*names)).alias("value"))
