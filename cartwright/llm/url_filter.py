"""Allow and block rules for URLs.

A URL is expanded into expressions: every suffix of its host at a dot, joined with every prefix of
its path at a slash. Expressions and rules meet on a short prefix of their SHA-256 digests; the
full digests confirm, and the longest rule decides. Hosts are expanded only as deep as the
deepest rule's, paths likewise; both depths come from the rules, so a URL has few expressions
however long it is. Rules whose path does not end at a slash are met by the prefixes
of just their lengths.

Each different (host, path) is judged once, so a URL that fills a third of the table costs one row.

Defined cases: a null URL, or one without ``://``, has an empty host and path, which no rule fits.
A URL that no rule fits is allowed (the default). Of equally long rules the one with the longer
host decides; a block beats an allow of the same text. Rules with a null or empty part are left out.
Columns of the pages stay; result columns replace equally named ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import ascii_lower

SHORT = 8  # hexadecimal digits of a digest that are joined on
ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", 2), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """``pages`` (url, ...) with host, path, rule and verdict, by ``rules`` (action, host, path)."""
    clean = rules.select(
        "action", ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path")
    ).filter("action is not null and rule_host <> '' and rule_path <> ''")
    # One row of sizes, whatever the number of rules: how deep to expand.
    slashed = F.col("rule_path").endswith("/")
    depth = clean.agg(
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.max(F.when(slashed, F.size(F.split("rule_path", "/")) - 1)).alias("slashes"),
        F.sort_array(F.collect_set(F.when(~slashed, F.length("rule_path")))).alias("lengths"),
    ).first()
    labels, slashes, lengths = depth["labels"] or 1, depth["slashes"] or 0, depth["lengths"] or []

    suffixes = F.array(*[F.substring_index("host", ".", -n) for n in range(1, labels + 1)])
    # The prefix up to the n-th slash, for as many slashes as there are.
    at_slash = [
        F.when(F.size(F.split("path", "/")) > n, F.concat(F.substring_index("path", "/", n), F.lit("/")))
        for n in range(1, slashes + 1)
    ]
    at_length = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]
    prefixes = F.array(F.lit(None).cast("string"), *at_slash, *at_length)
    wild = clean.withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
    wild = wild.withColumn("short", F.substring("digest", 1, SHORT))

    seen = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).distinct()
    expressions = (
        seen.withColumn("some_host", F.explode(F.array_distinct(suffixes)))
        .withColumn("some_path", F.explode(F.array_compact(F.array_distinct(prefixes))))
        .withColumn("own", _digest(F.col("some_host"), F.col("some_path")))
        .select("host", "path", "own", F.substring("own", 1, SHORT).alias("short"))
    )
    met = expressions.join(wild, "short").filter(F.col("own") == F.col("digest"))
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"),
        F.length("rule_host").alias("host_size"),
        (F.col("action") == BLOCK).alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("action").alias("action"),
    )
    best = met.groupBy("host", "path").agg(F.max(rank).alias("_best"))
    kept = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict", "_best"}]
    out = pages.select(*kept, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return (
        out.join(best, ["host", "path"], "left")
        .withColumn("rule", F.col("_best")["rule"])
        .withColumn("verdict", F.coalesce(F.col("_best")["action"], F.lit(default)))
        .select(*kept, "host", "path", "rule", "verdict")
    )
