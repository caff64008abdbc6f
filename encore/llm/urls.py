"""URL rules by hashed host-suffix and path-prefix expressions.

A rule is a host and a path. It fits a URL whose host is the rule's or a subdomain of it and whose path starts with the
rule's. Each distinct URL is expanded into expressions `host suffix + path prefix`; only suffixes and prefixes of
lengths that some rule has are made. Expressions meet rules by an equi-join on the first digits of their SHA-256, then
the full digest confirms. The longest rule wins; of equally long ones the longer host, then a block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_DIGITS = 8
# The rules of the query.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_and_path(url) -> tuple:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased. Path: then up to `?`, `#` or the end."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """`pages` with host, path, rule (`host + path` of the winning rule, or null) and verdict.

    Columns of those names that pages had before are replaced. The rules table must be a bounded list of host, path,
    verdict; only its distinct lengths reach the driver (at most as many as a URL has characters).

    Edge cases: a null URL or one without `://` has empty host and path, so no rule fits and the verdict is
    `otherwise`. Repeated pages each get a row. Hosts end with a dot only if a rule does. An empty table gives an empty
    result. A rule with null or empty host never fits; rules that differ only in verdict: block wins.
    """
    rules = rules.filter("host IS NOT NULL AND host <> '' AND path IS NOT NULL AND verdict IS NOT NULL")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    lengths = rules.agg(
        F.sort_array(F.collect_set(F.size(F.split("host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("path"))).alias("letters"),
    ).first()
    digest = F.sha2(F.concat_ws("\n", "host", "path"), 256)
    rules = rules.select(
        F.substring(digest, 1, PREFIX_DIGITS).alias("_short"), digest.alias("_digest"), F.col("host").alias("_rule_host"),
        F.col("path").alias("_rule_path"), "verdict",
    )
    host, path = host_and_path(F.col(url))
    own = ["host", "path", "rule", "verdict"]
    kept = [c for c in pages.columns if c not in own]
    rows = pages.withColumns({"_host": host, "_path": path})
    places = rows.select("_host", "_path").distinct()
    suffixes = F.array(*[
        F.when(F.size(F.split("_host", r"\.")) >= n, F.substring_index("_host", ".", -n)) for n in lengths["labels"]
    ]) if lengths["labels"] else F.array(F.lit(None).cast("string"))
    prefixes = F.array(*[
        F.when(F.length("_path") >= n, F.substring(F.col("_path"), 1, n)) for n in lengths["letters"]
    ]) if lengths["letters"] else F.array(F.lit(None).cast("string"))
    expressions = (
        places.select("_host", "_path", F.explode(F.array_compact(suffixes)).alias("_suffix"))
        .select("_host", "_path", "_suffix", F.explode(F.array_compact(prefixes)).alias("_prefix"))
        .withColumn("_full", F.sha2(F.concat_ws("\n", "_suffix", "_prefix"), 256))
        .withColumn("_short", F.substring("_full", 1, PREFIX_DIGITS))
    )
    hits = expressions.join(rules, "_short").filter("_full = _digest")
    strength = F.struct(
        F.length("_rule_host") + F.length("_rule_path"), F.length("_rule_host"), F.col("verdict") == "block"
    )
    best = hits.groupBy("_host", "_path").agg(
        F.max_by(F.struct(F.concat("_rule_host", "_rule_path").alias("rule"), "verdict"), strength).alias("_best")
    )
    best = best.select(F.col("_host").alias("_h"), F.col("_path").alias("_p"), "_best")
    joined = rows.join(best, (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_p")), "left")
    return joined.select(
        *[c for c in kept], F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(otherwise)).alias("verdict"),
    )
