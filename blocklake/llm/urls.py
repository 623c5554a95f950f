"""URL filters by host-suffix and path-prefix expressions, found by short hash prefixes and confirmed by full digests.

A rule is a host, a path and a verdict. It fits a URL whose host is the rule's or one of its subdomains and whose path starts
with the rule's path. Every rule has a shape: the labels of its host, the slashes of its path, and the characters after the last
slash. A URL is expanded into one expression for each shape that the rules have, so that every rule that fits it, and only such
a rule, is one of its expressions. Expressions meet rules by an equality join on the first bits of their SHA-256; what shares
a prefix is confirmed by the full digest, and the longest rule left wins.

Where rules are few enough to be sent to all tasks, each shape is one broadcast join and no URL is shuffled. Otherwise the
different URLs are judged once, salted so that a host with a third of them is spread over many tasks, and their verdicts are
joined to the rows. Spark expressions alone; only the rules' size and their shapes (numbers, no rows of URLs) reach the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.llm.common import spare, stored, table

#: Hexadecimal digits of a digest that the join goes by: 32 bits.
PREFIX = 8
#: Rules of up to so many bytes, of up to so many shapes, are sent to all tasks; others meet URLs by a shuffle.
MOST_BYTES, MOST_SHAPES = 16 << 20, 24
#: How often a rule, or a URL's verdict, is repeated where it meets URLs by a shuffle, so that frequent ones are split.
SALTS = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a rule's host cannot hold, as no URL's host does.
_NO_HOST = r"[/?#A-Z]"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or URL."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What stands after the host up to ``?``, ``#`` or the end; empty without ``://`` or URL."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _expression(host: Column, path: Column) -> Column:
    """One string for a host and a path: hosts hold no slash, and a path is empty or begins with one."""
    return F.concat(host, F.lit("/"), path)


def _of_shape(host: Column, path: Column, labels: Column, slashes: Column, rest: Column) -> Column:
    """The expression of a URL that a rule of this shape has if it fits: null if the path has too few slashes.

    A host with fewer labels, or a path that ends sooner, gives a shorter expression, which is that of another rule or of none.
    """
    before = F.call_function("substring_index", path, F.lit("/"), slashes)
    cut = F.when(slashes == 0, F.lit("")).when(F.length(before) < F.length(path), F.substring(path, F.lit(1), F.length(before) + 1 + rest))
    return _expression(F.call_function("substring_index", host, F.lit("."), -labels), cut)


def compiled(rules: DataFrame) -> DataFrame:
    """``labels, slashes, rest, prefix, rules``: the rules of a shape and a hash prefix, each with digest, host, path and verdict.

    Columns of ``rules``: ``host, path, verdict``, strings. A null host or path is empty, a rule without a verdict is none. Rules that
    repeat count once; of rules that differ in the verdict alone the greatest verdict holds (``block`` before ``allow``). A
    host with a capital letter or one of ``/?#``, or a path that is not empty and does not begin with ``/``, fits no URL.
    """
    host, path = F.coalesce("host", F.lit("")), F.coalesce("path", F.lit(""))
    known = rules.where(F.col("verdict").isNotNull()).select(host.alias("host"), path.alias("path"), "verdict")
    known = known.where(~F.col("host").rlike(_NO_HOST) & ((F.col("path") == "") | F.col("path").startswith("/")) & ~F.col("path").rlike("[?#]"))
    one = known.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    labels = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    digest = F.sha2(_expression(F.col("host"), F.col("path")), 256)
    rest = F.length(F.substring_index("path", "/", -1))
    shaped = one.select(labels.alias("labels"), _slashes(F.col("path")).alias("slashes"), rest.alias("rest"), F.substring(digest, 1, PREFIX).alias("prefix"), F.struct(digest.alias("digest"), "host", "path", "verdict").alias("rule"))
    return shaped.groupBy("labels", "slashes", "rest", "prefix").agg(F.collect_list("rule").alias("rules"))


def _weight(rule: Column) -> Column:
    """What decides between rules that fit one URL: the longest, of equals that with the longer host; null without a rule."""
    return F.when(rule.isNotNull(), F.struct((F.length(rule["host"]) + F.length(rule["path"])).alias("size"), F.length(rule["host"]).alias("host_size"), rule["host"].alias("host"), rule["path"].alias("path"), rule["verdict"].alias("verdict")))


def _by_broadcast(rows: DataFrame, found: DataFrame, shapes: list, host: str, path: str, best: str) -> DataFrame:
    """One join for each shape; a row keeps its place, and its best rule so far."""
    kept = [F.col(f"`{c}`") for c in rows.columns]
    digest, prefix, candidates = spare([*rows.columns, best], "digest", "prefix", "candidates")
    out = rows.withColumn(best, F.lit(None).cast("struct<size:int,host_size:int,host:string,path:string,verdict:string>"))
    for s in shapes:
        mine = found.where((F.col("labels") == s.labels) & (F.col("slashes") == s.slashes) & (F.col("rest") == s.rest)).select(F.col("prefix").alias(prefix), F.col("rules").alias(candidates))
        own = F.sha2(_of_shape(F.col(f"`{host}`"), F.col(f"`{path}`"), F.lit(s.labels), F.lit(s.slashes), F.lit(s.rest)), 256)
        met = out.withColumn(digest, own).withColumn(prefix, F.substring(digest, 1, PREFIX)).join(F.broadcast(mine), prefix, "left")
        fits = _weight(F.get(F.filter(candidates, lambda r: r["digest"] == F.col(f"`{digest}`")), F.lit(0)))
        out = met.select(*kept, F.greatest(F.col(f"`{best}`"), fits).alias(best))
    return out


def _by_shuffle(rows: DataFrame, found: DataFrame, shapes: list, host: str, path: str, best: str) -> DataFrame:
    """Different pairs of host and path are judged once; rules and verdicts are repeated over salts, so frequent ones are split."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    every = F.from_json(F.lit(json.dumps([s.asDict() for s in shapes])), "array<struct<labels:int,slashes:int,rest:int>>")
    urls = rows.select(F.col(f"`{host}`").alias("u_host"), F.col(f"`{path}`").alias("u_path")).distinct().withColumn("salt", F.pmod(F.xxhash64("u_host", "u_path"), F.lit(SALTS)).cast("int"))
    expressions = F.array_distinct(F.filter(F.transform(every, lambda s: F.sha2(_of_shape(F.col("u_host"), F.col("u_path"), s["labels"], s["slashes"], s["rest"]), 256)), lambda d: d.isNotNull()))
    asked = urls.select("u_host", "u_path", "salt", F.explode(expressions).alias("digest")).withColumn("prefix", F.substring("digest", 1, PREFIX))
    # two shapes may share a prefix, so that a prefix here may stand in several rows of rules, each of other digests
    met = asked.join(found.select("prefix", "rules", salts), ["prefix", "salt"]).select("u_host", "u_path", F.get(F.filter("rules", lambda r: r["digest"] == F.col("digest")), F.lit(0)).alias("rule"))
    judged = met.where(F.col("rule").isNotNull()).groupBy("u_host", "u_path").agg(F.max(_weight(F.col("rule"))).alias(best))
    own_host, own_path, salt = spare([*rows.columns, best], "u_host", "u_path", "salt")
    verdicts = judged.select(F.col("u_host").alias(own_host), F.col("u_path").alias(own_path), F.col(best), salts.alias(salt))
    dealt = rows.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    same = (F.col(f"`{host}`") == F.col(own_host)) & (F.col(f"`{path}`") == F.col(own_path))
    return dealt.join(verdicts.withColumnRenamed(salt, f"{salt}_of"), same & (F.col(salt) == F.col(f"{salt}_of")), "left").select(*[F.col(f"`{c}`") for c in rows.columns], F.col(best))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow", names: tuple[str, str, str, str] = ("host", "path", "rule", "verdict"), most_bytes: int = MOST_BYTES, most_shapes: int = MOST_SHAPES) -> DataFrame:
    """Every row of ``pages`` with four more columns (``names``): its host and path, the rule that decides, and the verdict.

    See :func:`compiled` for the columns of ``rules`` and :func:`host_of` for what a host is: user names and ports belong to it. Of
    the rules that fit, the one with the most characters of host and path decides, of equals the one with the longer host. Without
    a rule that fits, ``rule`` is null and ``verdict`` is ``otherwise``. A null, empty or relative URL has an empty host and path
    and is fitted by no rule but one that is empty in both; a rule with the path ``/`` does not fit a URL without a path. Rows that
    repeat are judged each, whatever their number; any other columns stay as they are, but columns of ``names`` must be free.
    """
    clash = {n.lower() for n in names} & {c.lower() for c in pages.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already: choose other names")
    host, path, rule, verdict = names
    (best,) = spare([*pages.columns, *names], "best")
    address = F.col(f"`{url}`")
    rows = pages.withColumns({host: host_of(address), path: path_of(address)})
    found = stored(compiled(rules), "url-rules")
    held = found.agg(F.sum(F.aggregate("rules", F.lit(0).cast("long"), lambda n, r: n + 200 + F.octet_length(r["host"]) + F.octet_length(r["path"])))).first()[0] or 0
    shapes = found.select("labels", "slashes", "rest").distinct().orderBy("labels", "slashes", "rest").collect()  # a few numbers, whatever the number of rules
    way = _by_broadcast if held <= most_bytes and len(shapes) <= most_shapes else _by_shuffle
    decided = way(rows, found, shapes, host, path, best)
    said = F.col(f"`{best}`")
    return decided.select(*[F.col(f"`{c}`") for c in rows.columns], F.concat(said["host"], said["path"]).alias(rule), F.coalesce(said["verdict"], F.lit(otherwise)).alias(verdict))


def allowed(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The rows of ``pages``, all columns, that no rule blocks; see :func:`judge`."""
    names = spare(pages.columns, "host", "path", "rule", "verdict")
    return judge(pages, rules, url, names=tuple(names)).where(F.col(names[3]) != "block").select(*[F.col(f"`{c}`") for c in pages.columns])


#: The rules of the query: host, path, verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with what the four rules say of its URL."""
    rules = spark.sql(f"SELECT * FROM VALUES {_VALUES} AS t(host, path, verdict)")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


QUERIES = {"op13_url_filters": query}
SQL = {
    "op13_url_filters": rf"""
WITH r(r_host, r_path, r_verdict) AS (VALUES {_VALUES}),
u AS (SELECT page_id, row_number() OVER () AS k, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS s FROM pages),
p AS (SELECT page_id, k, translate(regexp_extract(s, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(s, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT p.*, r_host || r_path AS rule, r_verdict FROM p JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)),
b AS (SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(r_verdict, length(rule)) AS verdict FROM f GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN b USING (k)"""
}
