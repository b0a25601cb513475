"""Allow and block verdicts for URLs by lists of host and path rules.

A rule names a host and a path; it fits the URLs of that host and of all its
subdomains whose path starts with the rule's path.  Every distinct (host, path) is
expanded into expressions, one for each suffix of its host and each prefix of its
path that ends in a slash, and a rule into the one expression of its host and its
path up to the last slash.  Expressions and rules meet in an equi-join on the first
four bytes of their SHA-256 digests; the full digest and the rest of the rule's path
are compared afterwards.  Of the rules that fit, the longest wins.

No URL is expanded beyond the largest number of labels and slashes of any rule, so a
URL of a megabyte of slashes costs no more than a short one.  Verdicts are found once
per distinct (host, path), which is small for a hot host or page, and an expression
that many of them share, such as ``net/``, is dealt over ``salts`` tasks.  Nothing is
broadcast by force: Spark does so for short lists by their size.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``,
``#`` or the end, A-Z in lower case, port and user included; the path goes from there
to ``?``, ``#`` or the end, unchanged, and may be empty.  A null url, or one
without ``://``, has an empty host and path, and the default verdict.  Of fitting rules of
equal length the one with the longer host wins, and block before allow.  Rules with a
null host, path or verdict are ignored.  Repeated rows stay repeated; rows without an
id keep their verdict; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The two parts of a URL that rules look at, never null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def _short(digest: Column) -> Column:
    """The first four bytes, as the key of the join."""
    return F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("bigint")


def _slashes(path: Column) -> Column:
    return F.size(F.split(path, "/")) - 1


def _up_to_slash(parts: Column, n: Column) -> Column:
    """A path split at its slashes, up to and with the n-th one."""
    return F.when(n == 0, F.lit("")).otherwise(
        F.concat(F.array_join(F.slice(parts, F.lit(1), n), "/"), F.lit("/"))
    )


def _last_labels(labels: Column, n: Column) -> Column:
    return F.array_join(F.slice(labels, -n, n), ".")


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as the table that :func:`judge_urls` takes."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def keyed_rules(rules: DataFrame) -> DataFrame:
    """Rules with the digest of their expression and the key that names them."""
    host, path = F.col("host"), F.col("path")
    parts = F.split(path, "/")
    whole = rules.select("verdict", "host", "path").dropna()
    return whole.select(
        F.translate(host, UPPER, LOWER).alias("rule_host"),
        path.alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
        F.size(F.split(host, r"\.")).alias("labels"),
        _slashes(path).alias("slashes"),
        _digest(
            F.concat(F.translate(host, UPPER, LOWER), F.lit("\n"), _up_to_slash(parts, _slashes(path)))
        ).alias("digest"),
    ).withColumn("short", _short(F.col("digest")))


def expressions(sites: DataFrame, labels: int, slashes: int) -> DataFrame:
    """Host-suffix and path-prefix expressions of each (host, path), by digest."""
    of_host, of_path = F.split("host", r"\."), F.split("path", "/")

    def counts(first: int, size: Column, most: int) -> Column:
        return F.sequence(F.lit(first), F.greatest(F.lit(first), F.least(size, F.lit(most))))

    suffixes = F.transform(
        counts(1, F.size(of_host), labels), lambda n: _last_labels(F.col("_labels"), n)
    )
    prefixes = F.transform(
        counts(0, F.size(of_path) - 1, slashes), lambda n: _up_to_slash(F.col("_parts"), n)
    )
    return (
        sites.withColumns({"_labels": of_host, "_parts": of_path})
        .select("host", "path", suffixes.alias("_suffixes"), prefixes.alias("_prefixes"))
        .withColumn("_suffix", F.explode("_suffixes"))
        .withColumn("_prefix", F.explode("_prefixes"))
        .select(
            "host", "path",
            _digest(F.concat("_suffix", F.lit("\n"), "_prefix")).alias("digest"),
        )
        .withColumn("short", _short(F.col("digest")))
    )


def fitting_rules(sites: DataFrame, rules: DataFrame, salts: int = SALTS) -> DataFrame:
    """The winning rule of each (host, path) that any rule fits."""
    keyed = keyed_rules(rules)
    deepest = keyed.agg(F.max("labels").alias("labels"), F.max("slashes").alias("slashes")).first()
    spread = keyed.drop("labels", "slashes").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    found = expressions(sites, deepest.labels or 0, deepest.slashes or 0).withColumn(
        "salt", F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int")
    )
    hits = (
        found.alias("e").join(spread.alias("r"), ["short", "salt"])
        .where(F.col("e.digest") == F.col("r.digest"))
        .where(F.startswith("path", "rule_path"))
    )
    length = F.length("rule_host") + F.length("rule_path")
    precedence = F.struct(
        length, F.length("rule_host"), F.col("rule_verdict") == "block", "rule_verdict"
    )
    return hits.groupBy("host", "path").agg(
        F.max_by(
            F.struct(F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")),
            precedence,
        ).alias("won")
    ).select("host", "path", "won.rule", "won.verdict")


def judge_urls(
    pages: DataFrame, rules: DataFrame, keys: list[str], url: str = "url",
    default: str = "allow", salts: int = SALTS,
) -> DataFrame:
    """``keys`` of every row with ``host``, ``path``, the winning ``rule`` and the ``verdict``.

    ``rules`` has the columns ``verdict``, ``host`` and ``path``; ``default`` is the verdict
    where none fits, and ``rule`` is null there.
    """
    host, path = host_and_path(F.col("_url"))
    named = {k: f"_key_{i}" for i, k in enumerate(keys)}
    parts = (
        pages.select(*[F.col(k).alias(n) for k, n in named.items()], F.col(url).alias("_url"))
        .select(*named.values(), host.alias("host"), path.alias("path"))
    )
    won = fitting_rules(parts.select("host", "path").distinct(), rules, salts)
    return parts.join(won, ["host", "path"], "left").select(
        *[F.col(n).alias(k) for k, n in named.items()], "host", "path", "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
