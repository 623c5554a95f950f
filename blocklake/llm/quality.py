"""Quality rules, line first: lines that fail a rule go, then documents that lost too much text go.

Built from Spark's own functions alone: every figure is an expression over one row, so the operator is one scan with no
shuffle. Words are found once a row; repeated three-word windows come from sorting the row's window hashes, which takes
n log n steps for n words and no window ever leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.llm.common import SPACE, let, spare, table

#: Fixed values of the base rules, as the query's contract states them.
MIN_WORDS, MAX_REPEAT_PERCENT, SYMBOLS = 50, 50, "#*$%&|<>"
#: Phrases of notices that site software adds; a short line with one is no prose.
BOILERPLATE = (
    "all rights reserved", "licensed under", "is licensed", "released under", "public license", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "use cookies", "uses cookies", "accept cookies", "enable javascript", "lorem ipsum", "subscribe to", "log in to", "click here",
    "read more", "share this", "skip to content", "back to top", "powered by",
)
#: Ends of a sentence; a line of one to three words without one is taken for navigation.
SENTENCE_END = r"[.!?…:;。！？][\"'”’»)\]]*\s*$"
#: What a link has, marks of which a tenth makes a line symbols, and bars between links.
LINKS = ("http://", "https://", "www.")
MARKS, BARS = "#*$%&|<>{}\\^~=", "|»›•·"
#: A notice or a link has at most so many characters.
SHORT_LINE = 240


def words_of(text: Column) -> Column:
    """All words: the text split at runs of the six white space characters, without what an end of the text leaves empty."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def repeated_words(words: Column) -> Column:
    """How many words lie in a three-word window that the same text has twice or more, the first one included."""

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - 3), lambda i: F.xxhash64(hashes[i], hashes[i + 1], hashes[i + 2]))

    def starts(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, i: (x["h"] == F.get(ordered, i - 1)["h"]) | (x["h"] == F.get(ordered, i + 1)["h"]))  # null beyond the ends
        return F.sort_array(F.transform(twice, lambda x: x["p"]))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).cast("int").alias("end"), F.lit(0).cast("long").alias("n"))
        step = lambda s, p: F.struct((p + 3).cast("int").alias("end"), (s["n"] + p + 3 - F.greatest(p, s["end"])).cast("long").alias("n"))
        return F.aggregate(at, start, step, lambda s: s["n"])

    def count(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(let(ordered, lambda o: covered(starts(o))))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(let(hashes, lambda h: let(windows(h), count)))


def count_of(text: Column, signs: str) -> Column:
    """How many characters are one of ``signs``; texts without any are told by one search."""
    return F.when(text.rlike(_any(signs)), F.length(text) - F.length(F.translate(text, signs, ""))).otherwise(F.lit(0))


def _any(signs: str) -> str:
    return "[" + "".join(f"\\{c}" for c in signs) + "]"


def with_phrase(text: Column) -> Column:
    """Whether a notice's phrase or a link is in the text, in lower case: if not, none is in any of its lines."""
    found = text.contains(LINKS[0])
    for phrase in (*LINKS[1:], *BOILERPLATE):
        found = found | text.contains(phrase)
    return found


def line_fails(line: Column, phrased: Column) -> Column:
    """A line that is symbols, a row of links, a notice, or one to three words with no end of a sentence.

    ``phrased``: whether its text has a phrase or link at all. Cheap tests come first, so that most lines meet no other.
    """
    n_words = F.regexp_count(line, F.lit(f"[^{SPACE}]+"))

    def notice(lower: Column) -> Column:
        found = (lower.contains(LINKS[0]) | lower.contains(LINKS[1]) | lower.contains(LINKS[2])) & (n_words <= 6)
        for phrase in BOILERPLATE:
            found = found | lower.contains(phrase)
        return found

    symbols = line.rlike(_any(MARKS)) & (count_of(line, MARKS) * 10 >= F.length(line))
    barred = line.rlike(_any(BARS)) & ((count_of(line, BARS) >= 3) | ((F.length(line) <= SHORT_LINE) & (n_words <= 12)))
    short = (phrased & let(F.lower(line), notice)) | (~line.rlike(SENTENCE_END) & (n_words < 4))
    return symbols | barred | ((F.length(line) <= SHORT_LINE) & short)


def quality_rules(docs: DataFrame, text: str = "text", max_lost_percent: int = 50) -> DataFrame:
    """Each row of ``docs`` with the figures and verdicts of the rules, and ``clean_text``, its text without failed lines.

    Added columns: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_words, base_failed, kept, clean_text``
    (columns of these names that ``docs`` has are replaced). Null and empty texts have no words, fail the base rules and have
    an empty ``clean_text``; rows that repeat are judged each by itself; an empty table gives an empty one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    judged = lambda x, phrased: F.transform(x, lambda line: F.struct(line.alias("line"), line_fails(line, phrased).alias("bad")))
    figures = F.struct(
        count_of(body, SYMBOLS).cast("long").alias("n_symbols"),
        let(let(F.lower(body), with_phrase), lambda phrased: let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup"), judged(x, phrased).alias("each")))).alias("lines"),
        let(words_of(body), lambda w: F.struct(F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"), repeated_words(w).alias("repeated"))).alias("w"),
    )
    own = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "base_failed", "kept", "clean_text"}
    rest = [c for c in docs.columns if c not in own]
    (f,) = spare([*rest, *own], "_f")
    # explode of a one-item array keeps the figures from being computed again in every expression that reads them
    one = docs.select(*[docs[f"`{c}`"] for c in rest], F.explode(F.array(figures)).alias(f))
    n, repeated, each = F.col(f"{f}.w.n"), F.col(f"{f}.w.repeated"), F.col(f"{f}.lines.each")
    lost = F.aggregate(F.filter(each, lambda x: x["bad"]), F.lit(0).cast("long"), lambda s, x: s + F.regexp_count(x["line"], F.lit(f"[^{SPACE}]+")))
    failed = (n < MIN_WORDS) | (repeated * 100 > n * MAX_REPEAT_PERCENT)
    return one.select(
        *[F.col(f"`{c}`") for c in rest], n.alias("n_words"), F.col(f"{f}.w.chars").alias("word_chars"), F.col(f"{f}.n_symbols").alias("n_symbols"), F.col(f"{f}.lines.n_dup").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"), lost.alias("lost_words"), failed.alias("base_failed"), (~failed & (lost * 100 <= n * max_lost_percent)).alias("kept"),
        F.array_join(F.transform(F.filter(each, lambda x: ~x["bad"]), lambda x: x["line"]), "\n").alias("clean_text"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words")


QUERIES = {"op3_quality_rules": query}
_PHRASES = " OR ".join(f"contains(low, '{p}')" for p in BOILERPLATE)

SQL = {
    "op3_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
tri AS (SELECT doc_id, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] AS s FROM d, unnest(range(1, len(w) - 1)) t(k)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS p FROM tri SEMI JOIN (SELECT doc_id, s FROM tri GROUP BY ALL HAVING count(*) > 1) USING (doc_id, s)) GROUP BY 1),
line AS (SELECT doc_id, x, lower(x) AS low, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
judged AS (SELECT *, (length(x) - length(translate(x, '#*$%&|<>{{}}\^~=', ''))) * 10 >= length(x) OR length(x) - length(translate(x, '|»›•·', '')) >= 3 OR (length(x) <= {SHORT_LINE} AND (
  ((contains(low, 'http://') OR contains(low, 'https://') OR contains(low, 'www.')) AND n <= 6) OR {_PHRASES} OR (length(x) - length(translate(x, '|»›•·', '')) >= 1 AND n <= 12)
  OR (n < 4 AND NOT regexp_matches(x, '[.!?…:;。！？]["''”’»)\]]*\s*$')))) AS bad FROM line),
by_doc AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup, CAST(coalesce(sum(n) FILTER (bad), 0) AS BIGINT) AS lost FROM judged GROUP BY 1),
f AS (SELECT doc_id, len(w) AS n_words, length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
  length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words, coalesce(lost, 0) AS lost_words FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN by_doc USING (doc_id))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND lost_words * 100 <= n_words * 50 AS kept FROM f"""
}
