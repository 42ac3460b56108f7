"""URL rules by host-suffix and path-prefix expressions.

A rule names a host and the start of a path. Every URL is expanded into the
expressions that a rule fitting it could have: suffixes of its host at label
boundaries, joined with prefixes of its path, of just the shapes (labels, path
length) that the rules have. A short hash prefix of each expression is an equi-join
key; full digests confirm a match and the longest rule decides. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of the digest that are the join key.
PREFIX_DIGITS = 8
#: Beyond this many rules they are joined by a shuffle and no longer broadcast.
BROADCAST_RULES = 100_000
#: Copies of each rule, and salts of the URLs' expressions, in that shuffle.
SALTS = 32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SCHEMA = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    return F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each row of ``pages``.

    ``rules`` has (host, path, verdict). A rule fits its host and all subdomains, if the
    URL's path starts with the rule's; of the rules that fit, the one with the longest
    host and then the longest path decides, and among equal ones the least verdict.
    Without a rule the verdict is ``default``.

    A null URL or one without ``://`` has empty host and path and no rule. Rules with a null
    or empty host fit nothing, a null path is an empty one. Pages that repeat are judged
    each for itself; hosts and paths may be of any length. Empty tables give no rows or
    no rules. Other columns are not read.
    """
    known = rules.select(
        F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    ).filter("host <> ''").groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    # The shapes of all rules: two small numbers each, as many as there are different ones.
    shapes = [(r.labels, r.size) for r in known.select(
        _labels(F.col("host")).alias("labels"), F.length("path").alias("size")).distinct().collect()]
    by_labels: dict[int, list[int]] = {}
    for labels, size in sorted(shapes):
        by_labels.setdefault(labels, []).append(size)

    read = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    parts = read.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not shapes:
        return parts.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    def expression(host: Column, path: Column) -> Column:
        return F.concat(host, F.lit("\n"), path)

    def fits(labels: int, size: int) -> Column:
        return (F.col("host") != "") & (_labels(F.col("host")) >= labels) & (F.length("path") >= size)

    shape_rows = [
        F.when(fits(labels, size), F.struct(
            F.substring_index("host", ".", -labels).alias("h"), F.substring("path", 1, size).alias("p")))
        for labels, sizes in by_labels.items() for size in sizes
    ]
    asked = (
        parts.withColumn("row", F.monotonically_increasing_id())
        .withColumn("e", F.explode_outer(F.filter(F.array(*shape_rows), lambda e: e.isNotNull())))
        .withColumn("asked", F.sha2(expression(F.col("e.h"), F.col("e.p")).cast("binary"), 256))
        .select("row", "page_id", "host", "path", "asked", F.substring("asked", 1, PREFIX_DIGITS).alias("short"))
    )
    keyed = known.select(
        F.sha2(expression(F.col("host"), F.col("path")).cast("binary"), 256).alias("full"),
        F.struct(F.length("host").alias("host_size"), F.length("path").alias("path_size"),
                 F.concat("host", "path").alias("name"), F.col("verdict").alias("says")).alias("found"))
    keyed = keyed.withColumn("short", F.substring("full", 1, PREFIX_DIGITS))
    if known.limit(broadcast_rules + 1).count() <= broadcast_rules:
        met = asked.join(F.broadcast(keyed), "short", "left")
    else:
        # A common host suffix is in most URLs, so its rule is copied to all salts.
        salted = keyed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = asked.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(salted, ["short", "salt"], "left")
    best = met.groupBy("row", "page_id", "host", "path").agg(
        F.max(F.when(F.col("full") == F.col("asked"), F.col("found"))).alias("found"))
    return best.select(
        "page_id", "host", "path", F.col("found.name").alias("rule"), F.coalesce("found.says", F.lit(default)).alias("verdict"))
