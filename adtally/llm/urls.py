"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens that any URL it fits must hold. The tokens' counts over all
URLs pick each rule's rarest one as its index entry; a URL's tokens fetch candidate rules there, and only those
run their expressions. It is one pass of column expressions without a shuffle, after one that counts tokens.
"""

from __future__ import annotations

import re
from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Verdict, host and path of the rules that come first.
BASE = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Verdict, name, expression over host and path, and literal tokens, of patterns for URLs that no base rule fits.
PATTERNS = (
    ("block", "casino", r"^(?:[^/]*\.)?casino-[a-z0-9]+\.", ("casino",)),
    ("block", "bets", r"^(?:[^/]*\.)?[a-z0-9]+-bets\.", ("bets",)),
    ("block", "pills", r"^(?:[^/]*\.)?[a-z0-9]+-pills\.", ("pills",)),
    ("block", "ads", r"^(?:[^/]*\.)?ads-track\.", ("ads", "track")),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    base: bool


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """The rule of a host with its subdomains and a path prefix, as an expression over host and path."""
    quoted = re.sub(r"([^A-Za-z0-9/])", r"\\\1", host + path)
    # The last piece of a path may go on in the URL, so it is no whole token unless a separator ends it.
    whole = re.sub(r"[A-Za-z0-9]+$", "", path)
    literals = tuple(t for t in re.split(r"[^a-z0-9]+", f"{host}/{whole}".lower()) if t)
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{quoted}", literals, True)


def standard_rules() -> list[Rule]:
    return [host_rule(*r) for r in BASE] + [Rule(n, v, p, t, False) for v, n, p, t in PATTERNS]


def _after_scheme() -> Column:
    return F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """page_id, host and path of ``pages``; both empty where the url is null or has no ``://``."""
    return pages.select("page_id", "url").select(
        "page_id",
        F.translate(F.regexp_extract(_after_scheme(), r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
        F.regexp_extract(_after_scheme(), r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def _tokens() -> Column:
    return F.array_distinct(F.split(F.lower(F.concat("host", "path")), "[^a-z0-9]+"))


def rule_index(parsed: DataFrame, rules: list[Rule]) -> dict[str, list[Rule]]:
    """Rules by their rarest literal token; '' holds rules without one, which every URL is run through.

    The counts cover all URLs, and are as many numbers as the rules have tokens.
    """
    wanted = sorted({t for r in rules for t in r.literals})
    token = F.explode(F.array_intersect(_tokens(), F.split(F.lit(" ".join(wanted)), " "))).alias("token")
    seen = {r["token"]: r["count"] for r in parsed.select(token).groupBy("token").count().collect()}
    index = defaultdict(list)
    for rule in rules:
        index[min(rule.literals, key=lambda t: (seen.get(t, 0), t), default="")].append(rule)
    return dict(index)


def judge(pages: DataFrame, rules: list[Rule] | None = None, otherwise: str = "allow") -> DataFrame:
    """For every row of ``pages``: page_id, host, path, rule, verdict, pattern.

    The longest base rule that fits decides; else a pattern, named in ``pattern``; else ``otherwise``. A null url,
    or one without ``://``, has an empty host and path, so no rule. Rows that repeat give rows that repeat; an empty
    table gives none.
    """
    rules = standard_rules() if rules is None else rules
    parsed = with_host_and_path(pages)
    index = rule_index(parsed, rules)

    def entry(rule: Rule) -> Column:
        return F.struct(
            F.lit(rule.base).alias("base"), F.lit(len(rule.name)).alias("length"), F.lit(rule.name).alias("name"),
            F.lit(rule.verdict).alias("verdict"), F.lit(rule.pattern).alias("pattern"),
        )

    always = [entry(r) for r in index.pop("", [])]
    pairs = [part for token, held in sorted(index.items()) for part in (F.lit(token), F.array(*map(entry, held)))]
    judged = parsed.withColumn("subject", F.concat("host", "path")).withColumn("tokens", _tokens())
    lists = [F.array(*always)] if always else []
    if pairs:
        by_token = F.create_map(*pairs)
        hits = F.filter("tokens", lambda t: F.map_contains_key(by_token, t))
        lists.append(F.flatten(F.transform(hits, lambda t: F.element_at(by_token, t))))
    if not lists:
        raise ValueError("there are no rules")
    fitting = F.filter(F.concat(*lists), lambda r: F.rlike(F.col("subject"), r["pattern"]))
    best = judged.withColumn("best", F.array_max(fitting))
    return best.select(
        "page_id", "host", "path",
        F.when(F.col("best.base"), F.col("best.name")).alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(otherwise)).alias("verdict"),
        F.when(~F.col("best.base"), F.col("best.name")).alias("pattern"),
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP7_SQL = r"""
WITH after_scheme AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parsed AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM after_scheme
), fitted AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
            THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/')
            THEN 'example.com/en/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    END AS rule, CASE
        WHEN regexp_matches(host || path, '^([^/]*\.)?[a-z0-9]+-pills\.') THEN 'pills'
        WHEN regexp_matches(host || path, '^([^/]*\.)?casino-[a-z0-9]+\.') THEN 'casino'
        WHEN regexp_matches(host || path, '^([^/]*\.)?[a-z0-9]+-bets\.') THEN 'bets'
        WHEN regexp_matches(host || path, '^([^/]*\.)?ads-track\.') THEN 'ads'
    END AS named
    FROM parsed
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN named IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL THEN named END AS pattern
FROM fitted
"""
