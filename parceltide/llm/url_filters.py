"""URL filters: rules indexed by their rarest literal token.

A URL is cut into its letter-and-digit tokens, which fetch the rules stored
under them; only those rules run their regular expression. All of it is
DataFrame work: one join on tokens and one aggregate per distinct URL.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parceltide.session import stage

MOST_BROADCAST_RULES = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class PathRule:
    """Fits a host and all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def pattern(self) -> str:
        return rf"^(?:[^/]*\.)?{re.escape(self.host)}{re.escape(self.path)}"

    def tokens(self) -> list[str]:
        # the last token of the path may go on in the URL, so it counts only if a delimiter follows it
        closed = re.sub(r"[A-Za-z0-9]+$", "", self.path)
        return [t for t in re.split(r"[^a-z0-9]+", (self.host + closed).lower()) if t]


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over host and path that needs the literal token ``needs``."""

    verdict: str
    name: str
    expression: str
    needs: tuple[str, ...]


PATH_RULES = (
    PathRule(ALLOW, "com", "/"), PathRule(BLOCK, "example.com", "/en/"), PathRule(ALLOW, "www.example.com", "/en/"),
    PathRule(BLOCK, "net", "/es/"), PathRule(BLOCK, "net", "/fr/"),
)


def _label(word: str) -> PatternRule:
    """Blocks hosts where ``word`` is a whole part of a label."""
    return PatternRule(BLOCK, word, rf"^(?:[^/]*[.-])?{word}(?:[.-]|/|$)", (word,))


# The method's own rules: host parts that name gambling, adult, betting and spam sites.
PATTERN_RULES = tuple(
    map(_label, ("adult", "bet", "bets", "betting", "casino", "escort", "gambling", "poker", "porn", "spam", "viagra", "xxx"))
)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#``; path: then up to ``?``, ``#``. Else both empty."""
    after = F.expr(f"CASE WHEN instr(`{url}`, '://') > 0 THEN substring(`{url}`, instr(`{url}`, '://') + 3) ELSE '' END")
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def rule_table(spark: SparkSession, paths: Sequence[PathRule], patterns: Sequence[PatternRule]) -> DataFrame:
    """(rule_id, rule, name, verdict, size, pattern, tokens); path rules have a ``rule`` text."""
    rows = [(r.text, None, r.verdict, len(r.text), r.pattern(), r.tokens()) for r in paths]
    rows += [(None, r.name, r.verdict, 0, r.expression, [t.lower() for t in r.needs]) for r in patterns]
    schema = "rule_id long, rule string, name string, verdict string, size int, pattern string, tokens array<string>"
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def _tokens(target: Column) -> Column:
    """Distinct tokens, plus the empty one, under which rules without a literal are stored."""
    return F.array_distinct(F.concat(F.split(lower_ascii(target), "[^a-z0-9]+"), F.array(F.lit(""))))


def rarest_token_index(urls: DataFrame, rules: DataFrame, sent: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row per rule with the literal ``token`` that the fewest URLs hold; ``sent`` may broadcast a rule table."""
    literals = rules.select("rule_id", F.explode_outer("tokens").alias("token")).fillna("", ["token"])
    wanted = sent(literals.select("token").distinct())
    counts = urls.select(F.explode("tokens").alias("token")).join(wanted, "token").groupBy("token").agg(
        F.count("*").alias("n")
    )
    ranked = literals.join(counts, "token", "left").groupBy("rule_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest")
    )
    return rules.join(ranked, "rule_id").select("*", F.col("rarest.token").alias("token")).drop("rarest", "tokens")


def url_verdicts(
    pages: DataFrame, url_column: str = "url", paths: Sequence[PathRule] = PATH_RULES,
    patterns: Sequence[PatternRule] = PATTERN_RULES,
) -> DataFrame:
    """(url, host, path, rule, verdict, pattern) of every distinct non-null URL.

    The longest fitting path rule decides; without one, a fitting pattern rule
    (block before allow, then by name); without any, allow. ``pattern`` names the
    pattern rule that fits, if any.
    """
    spark = pages.sparkSession
    host, path = host_and_path()
    urls = pages.select(F.col(url_column).alias("url")).where(F.col("url").isNotNull()).distinct().select(
        "url", host.alias("host"), path.alias("path")
    )
    urls = stage(urls.withColumn("tokens", _tokens(F.concat("host", "path"))), "urls")
    # rules up to a checked number travel to the URLs; a larger list meets them in a shuffle
    sent = F.broadcast if len(paths) + len(patterns) <= MOST_BROADCAST_RULES else lambda frame: frame
    index = sent(stage(rarest_token_index(urls, rule_table(spark, paths, patterns), sent), "rules"))
    fits = (
        urls.select("url", F.concat("host", "path").alias("target"), F.explode("tokens").alias("token"))
        .join(index, "token").where(F.expr("target RLIKE pattern"))
    )
    best = fits.groupBy("url").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct("size", "rule", "verdict"))).alias("by_path"),
        F.max(F.when(F.col("rule").isNull(), F.struct("verdict", "name"))).alias("by_pattern"),
    )
    return urls.join(best, "url", "left").select(
        "url", "host", "path", F.col("by_path.rule").alias("rule"),
        F.coalesce("by_path.verdict", "by_pattern.verdict", F.lit(ALLOW)).alias("verdict"),
        F.col("by_pattern.name").alias("pattern"),
    )


def filter_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", **rules) -> DataFrame:
    """(id, url, host, path, rule, verdict, pattern) of every row; a null URL has empty parts and is allowed."""
    verdicts = url_verdicts(pages, url_column, **rules).withColumnRenamed("url", "_url")
    narrow = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"))
    return narrow.join(verdicts, F.col("url") == F.col("_url"), "left").select(
        "id", "url", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
        "rule", F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"), "pattern",
    )
