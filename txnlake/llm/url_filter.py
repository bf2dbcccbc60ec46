"""URL filters: pattern rules found through their rarest literal token, DataFrame functions only.

Two kinds of rules. Domain rules (host, path, action) fit a host and all its subdomains when the
URL's path starts with the rule's path. Pattern rules are wildcard patterns over the whole URL
(``*`` any run, ``^`` a separator or the end, letter case ignored). A pattern is filed under that
literal token of it which is rarest among the tokens of the given URLs; a URL fetches the rules
filed under its own tokens by an equi-join, and only those run their regular expression.
Patterns without a whole literal token are filed under a token that every URL has.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (action, pattern) of the default list; block wins over allow only by the longer pattern.
PATTERN_RULES: tuple[tuple[str, str], ...] = (
    ("block", "^spam-farm.*"),
    ("block", "^casino^"),
    ("block", "^adult^"),
    ("block", "^clickbait*"),
    ("block", "*utm_source=feed^*-ads-*"),
    ("block", "^free-download^*.exe^"),
    ("block", "*porn*"),
    ("allow", "^spam-farm.example.org/about^"),
)

EVERY_URL = ""


def pattern_regex(pattern: str) -> str:
    """The Java regular expression of a wildcard pattern, to be found anywhere in a URL."""
    out = []
    for ch in pattern.strip("*"):
        if ch == "*":
            out.append(".*")
        elif ch == "^":
            out.append("(?:^|[^A-Za-z0-9_%-]|$)" if not out else "(?:[^A-Za-z0-9_%-]|$)")
        else:
            out.append(re.escape(ch) if not ch.isalnum() else ch)
    return "(?is)" + "".join(out)


def literal_tokens(pattern: str) -> list[str]:
    """Runs of ASCII letters and digits that any fitting URL holds as whole tokens.

    A run next to a wildcard, or at an open end of the pattern, may be part of a longer token
    of the URL and does not count.
    """
    tokens = []
    for m in re.finditer(r"[a-z0-9]+", pattern.lower()):
        before, after = pattern[: m.start()][-1:], pattern[m.end() :][:1]
        if before not in ("", "*") and after not in ("", "*"):
            tokens.append(m.group())
    return sorted(set(tokens))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL or without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substring(text, at + F.lit(3), F.length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def url_tokens(url: Column) -> Column:
    """Distinct lower-case letter and digit runs of a URL, and the token every URL has."""
    runs = F.split(ascii_lower(url), "[^a-z0-9]+")
    return F.array_union(F.array_distinct(runs), F.array(F.lit(EVERY_URL)))


def host_suffixes(host: Column, most_labels: int) -> Column:
    """The last 1, 2, ... ``most_labels`` labels: ``a.b.c`` gives ``c``, ``b.c`` and ``a.b.c``.

    No rule has more labels than ``most_labels``, so no longer parent can fit one.
    """
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(most_labels))),
        lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."),
    )


def index_patterns(
    spark: SparkSession, urls: DataFrame, rules: Sequence[tuple[str, str]]
) -> DataFrame:
    """Rules (rule, action, regex, rank) filed under their rarest token among ``urls`` (url, n)."""
    listed = [
        (i, pattern, action, pattern_regex(pattern), literal_tokens(pattern) or [EVERY_URL])
        for i, (action, pattern) in enumerate(rules)
    ]
    schema = "rank int, rule string, action string, regex string, tokens array<string>"
    filed = spark.createDataFrame(listed, schema).withColumn("token", F.explode("tokens"))
    seen = (
        urls.select("n", F.explode(url_tokens(F.col("url"))).alias("token"))
        .join(filed.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .agg(F.sum("n").alias("n_urls"))
    )
    rarest = F.min_by(F.col("token"), F.struct(F.coalesce("n_urls", F.lit(0)), F.col("token")))
    return (
        filed.join(seen, "token", "left")
        .groupBy("rank", "rule", "action", "regex")
        .agg(rarest.alias("token"))
    )


def judge_urls(
    spark: SparkSession,
    pages: DataFrame,
    domain_rules: Sequence[tuple[str, str, str]],
    pattern_rules: Sequence[tuple[str, str]] = PATTERN_RULES,
) -> DataFrame:
    """Every row of pages (page_id, url) with host, path, rule, pattern_rule and verdict.

    ``domain_rules`` are (action, host, path). The longest fitting domain rule decides; where
    none fits, the longest fitting pattern rule (ties: the earlier one); else the URL is
    allowed. Work is done once for each distinct URL. A NULL or empty URL has an empty host
    and path, no rule, and is allowed. Rows are never merged or dropped, repeated ids included.
    """
    urls = pages.groupBy("url").agg(F.count(F.lit(1)).alias("n")).where("url IS NOT NULL")
    host, path = split_url(F.col("url"))

    domains = spark.createDataFrame(
        [(a, h, p, f"{h}{p}") for a, h, p in domain_rules],
        "domain_action string, rule_host string, rule_path string, rule string",
    )
    depth = max((h.count(".") + 1 for _, h, _ in domain_rules), default=1)
    parents = F.explode(host_suffixes(host, depth))
    by_host = (
        urls.select("url", path.alias("path"), parents.alias("rule_host"))
        .join(domains, "rule_host")
        .where(F.expr("startswith(path, rule_path)"))
        .groupBy("url")
        .agg(
            F.max_by(
                F.struct("rule", "domain_action"), F.struct(F.length("rule"), F.col("rule"))
            ).alias("d")
        )
        .select("url", "d.rule", "d.domain_action")
    )
    index = index_patterns(spark, urls, pattern_rules)
    by_pattern = (
        urls.select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
        .join(index.withColumnRenamed("rule", "pattern"), "token")
        .where(F.regexp_like(F.col("url"), F.col("regex")))
        .groupBy("url")
        .agg(
            F.max_by(
                F.struct("pattern", "action"), F.struct(F.length("pattern"), -F.col("rank"))
            ).alias("p")
        )
        .select("url", F.col("p.pattern").alias("pattern_rule"), F.col("p.action").alias("pattern_action"))
    )
    return (
        pages.join(by_host, "url", "left")
        .join(by_pattern, "url", "left")
        .select(
            "page_id",
            host.alias("host"),
            path.alias("path"),
            "rule",
            "pattern_rule",
            F.coalesce("domain_action", "pattern_action", F.lit("allow")).alias("verdict"),
        )
    )
