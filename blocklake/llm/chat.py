"""Chat formatting: the turns of a conversation as one marked string with a loss mask, and the exact way back.

Relational, in Spark expressions alone: the turns of a conversation are collected as structs and sorted, adjacent turns of one
role are merged by array aggregation, and the blocks are concatenated. All of it needs one shuffle, by conversation. Where
blocks begin is found by filtering positions, so that the aggregation is over whole slices and takes steps in proportion to
the turns, never copying what has been put together so far.

Template: ``<|start|>role<|text|>`` opens a block, ``<|next|>`` stands between merged turns of one role, ``<|end|>`` closes
the block. Control strings inside roles and texts (``<|``, and those common in other templates) get a backslash after
their first sign, and backslashes are doubled, so everything comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.llm.common import let, table

START, TEXT, NEXT, END = "<|start|>", "<|text|>", "<|next|>", "<|end|>"
#: Where a control string has its first sign and its rest.
_CONTROL = r"(?:(?<=<){0}(?=\||/?s>|/?SYS>)|(?<=\[){0}(?=/?INST\]))"


def escape(text: Column) -> Column:
    """Doubles backslashes, then puts one after the first sign of each control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL.format(""), "\\\\")


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`: single backslashes only stand where it put them."""
    return F.replace(F.regexp_replace(text, _CONTROL.format(r"\\"), ""), F.lit("\\\\"), F.lit("\\"))


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv_id, formatted, loss_spans``: a row for each conversation of the rows ``conv_id, turn, role, text``.

    ``loss_spans`` has a ``(start, length)`` in code points of ``formatted`` for each text of a loss role, escapes included,
    marks not. Turns stand in order of turn, then role and text, nulls first, so ties have one result and repeated rows stay.
    A null text or role is an empty one; rows with a null ``conv_id`` are one conversation; an empty table gives an empty one;
    other columns are left out.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turn = F.struct("turn", "role", "text", escape(F.col("text")).alias("escaped"))
    each = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def merged(ts: Column) -> Column:
        """Blocks ``role, texts`` of the sorted turns: from each turn whose role is not that of the one before, up to the next such."""
        same = lambda i: (i > 0) & (F.get(ts, i)["role"] == F.get(ts, i - 1)["role"])
        opens = F.filter(F.sequence(F.lit(0), F.size(ts) - 1), lambda i: ~same(i))
        block = lambda i, k, o: let(F.slice(ts, i + 1, F.coalesce(F.get(o, k + 1), F.size(ts)) - i), lambda own: F.struct(own[0]["role"].alias("role"), F.transform(own, lambda t: t["escaped"]).alias("texts")))
        return let(opens, lambda o: F.transform(o, lambda i, k: block(i, k, o)))

    def parts(bs: Column) -> Column:
        """Of each turn, in order: its role, the lengths of what the string has before its text, of the text, and of what follows."""
        head = lambda b: F.length(F.concat(F.lit(START), escape(b["role"]), F.lit(TEXT)))
        return F.flatten(F.transform(bs, lambda b: F.transform(b["texts"], lambda t, k: F.struct(
            b["role"].alias("role"), F.when(k == 0, head(b)).otherwise(F.lit(len(NEXT))).alias("before"), F.length(t).alias("length"), F.when(k == F.size(b["texts"]) - 1, F.lit(len(END))).otherwise(F.lit(0)).alias("after"),
        ))))

    def spans(ps: Column) -> Column:
        starts = sums_before(F.transform(ps, lambda p: p["before"] + p["length"] + p["after"]))
        placed = F.zip_with(ps, starts, lambda p, s: F.struct(p["role"].alias("role"), (s + p["before"]).cast("int").alias("start"), p["length"].alias("length")))
        return F.transform(F.filter(placed, lambda p: p["role"].isin(*loss_roles)), lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")))

    blocks = each.select("conv_id", F.explode(F.array(merged(F.col("turns")))).alias("blocks"))
    written = F.transform("blocks", lambda b: F.concat(F.lit(START), escape(b["role"]), F.lit(TEXT), F.array_join(b["texts"], NEXT), F.lit(END)))
    return blocks.select("conv_id", F.array_join(written, "").alias("formatted"), let(parts(F.col("blocks")), spans).alias("loss_spans"))


def sums_before(values: Column) -> Column:
    """The sum ahead of each number of a list; in stretches of the square root of its length, since a list is copied as it grows."""
    last = lambda s: F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit(0))
    total = lambda v: F.aggregate(v, F.lit(0), lambda s, x: s + x)
    upto = lambda v: F.aggregate(v, F.array().cast("array<int>"), lambda s, x: F.concat(s, F.array(last(s) + x)))

    def whole(v: Column) -> Column:
        k = F.ceil(F.sqrt(F.size(v))).cast("int")
        stretches = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / k).cast("int")), lambda i: F.slice(v, i * k + 1, k))
        ahead = lambda own, base: F.zip_with(upto(own), own, lambda s, x: s - x + base)
        each = lambda ss: F.flatten(F.zip_with(ss, upto(F.transform(ss, total)), lambda own, s: ahead(own, s - total(own))))
        return let(stretches, each)

    return F.when(F.size(values) == 0, values).otherwise(let(values, whole))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_texts, formatted_chars``, read from the strings and spans of :func:`format_conversations`.

    ``turns`` are structs of role and text as they were before formatting, ``loss_texts`` the texts under the mask.
    """
    mark = lambda m: m.replace("|", r"\|")
    blocks = F.filter(F.split("formatted", mark(END)), lambda b: b != "")

    def turns(block):
        role = unescape(F.substring(F.split(block, mark(TEXT))[0], len(START) + 1, 1 << 30))
        return F.transform(F.split(F.split(block, mark(TEXT))[1], mark(NEXT)), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    masked = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.select("conv_id", F.flatten(F.transform(blocks, turns)).alias("turns"), masked.alias("loss_texts"), F.length("formatted").cast("long").alias("formatted_chars"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql("SELECT -7L AS conv_id, n AS turn, if(n = 0, 'user', 'assistant') AS role, '</s>[INST] ok [/INST]' AS text FROM (SELECT explode(array(0L, 1L)) AS n)")
    back = read_back(format_conversations(rows.unionByName(own)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )


QUERIES = {"op4_chat_formatting": query}

SQL = {
    "op4_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), o AS (
  SELECT *, row_number() OVER w AS n, coalesce(lag(role) OVER w <> role, true) AS opens, coalesce(lead(role) OVER w <> role, true) AS closes,
    length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(text, '<(\||/?s>|/?SYS>)|\[/?INST\]')) AS text_size,
    length(role) + length(role) - length(replace(role, '\', '')) + len(regexp_extract_all(role, '<(\||/?s>|/?SYS>)|\[/?INST\]')) AS role_size
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_size + CASE WHEN opens THEN 17 + role_size ELSE 8 END + CASE WHEN closes THEN 7 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id""",
}
