"""Robots rules as data: one row per origin, applied to URLs by a join."""

from __future__ import annotations

from urllib.parse import unquote
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleloom.functions.urls import origin
from titleloom.plans.durable import stored

# Fixed value: the default agent name that rules are looked up for.
AGENT = "MySimpleCrawler/1.0"
#: An origin with more rules than this is asked by prefixes and not rule by rule.
MANY_RULES = 64
_RULES = "array<struct<allow:boolean,path:string>>"


def _rules_for(agent: str, text: str) -> list[dict]:
    parser = RobotFileParser()
    parser.parse(text.splitlines())
    named = [entry for entry in parser.entries if entry.applies_to(agent)]
    entry = named[0] if named else parser.default_entry
    lines = entry.rulelines if entry else []
    return [{"allow": line.allowance, "path": unquote(line.path)} for line in lines]


def parsed_rules(text: Column, agent: str = AGENT) -> Column:
    """Ordered rules of the entry that holds for ``agent``."""

    @F.pandas_udf(_RULES)
    def parse(texts: pd.Series) -> pd.Series:
        return pd.Series([_rules_for(agent, t) if t else [] for t in texts], dtype=object)

    return parse(text)


def robots_rules(robots: DataFrame, agent: str = AGENT) -> DataFrame:
    """``(origin, rules)``; a status without rules becomes one rule for every path.

    401 and 403 deny all, other 4xx allow all, 5xx deny all, and an unreadable file (NULL status)
    allows all. Of several answers of an origin the one with the lowest status and text counts, NULL first.
    """
    status = F.col("status")
    everything = lambda allow: F.array(
        F.struct(F.lit(allow).alias("allow"), F.lit("").alias("path"))
    ).cast(_RULES)
    rules = (
        F.when(status.isNull(), everything(True))
        .when(status.isin(401, 403) | (status >= 500), everything(False))
        .when(status >= 400, everything(True))
        .otherwise(parsed_rules(F.when(status < 400, F.col("robots_txt")), agent))
    )
    answers = robots.groupBy("origin").agg(F.min(F.struct("status", "robots_txt")).alias("answer"))
    return answers.select("origin", "answer.*").select("origin", rules.alias("rules"))


def robots_path(url: Column) -> Column:
    """Decoded path and query that rules are compared with; ``/`` when empty."""
    escaped = F.regexp_replace(
        F.regexp_replace(url, r"%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B"
    )
    plain = F.when(F.contains(url, F.lit("%")), F.try_url_decode(escaped)).otherwise(url)
    path = F.regexp_replace(plain, r"\A[^:/?#]+://[^/?#]*", "")
    return F.when(path == "", F.lit("/")).otherwise(path)


def rule_nodes(rules: DataFrame) -> DataFrame:
    """``(origin, prefix, place, allow)``: the rules as nodes of a prefix tree per origin.

    A node holds the first of the rules with its path; ``place`` is its order among all rules of the origin.
    """
    each = rules.select("origin", F.posexplode("rules").alias("place", "rule"))
    first = F.min(F.struct("place", "rule.allow")).alias("first")
    return each.groupBy("origin", F.col("rule.path").alias("prefix")).agg(first).select("origin", "prefix", "first.*")


def _denied(asked: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(origin, path)`` of ``asked`` whose first rule forbids them, found by their prefixes.

    Only lengths that some rule of the origin has are looked up; ``asked`` is distinct.
    """
    size = F.explode(F.filter("sizes", lambda n: n <= F.char_length("path"))).alias("size")
    ways = asked.select("origin", "path", size).withColumn("prefix", F.expr("substring(path, 1, size)"))
    met = ways.join(nodes, ["origin", "prefix"]).groupBy("origin", "path")
    return met.agg(F.min(F.struct("place", "allow")).alias("first")).filter(~F.col("first.allow")).select("origin", "path")


def robots_filter(urls: DataFrame, robots: DataFrame, agent: str = AGENT, many: int = MANY_RULES) -> DataFrame:
    """URLs that ``agent`` may fetch. The first rule whose path is a prefix decides.

    Rules are stored first. The join has no hint, so they are broadcast only when Catalyst knows them to be
    small; else adaptive execution splits an origin with many URLs. An origin with more than ``many`` rules
    sends along the lengths of their paths only; its URLs look up their prefixes of these lengths among the
    nodes of its prefix tree, so their work does not grow with the number of rules. The result is the same.
    """
    rules = stored(robots_rules(robots, agent), "rules")
    large = rules.filter(F.size("rules") > many)
    row = urls.select(F.struct("*").alias("row"), origin(F.col("url")).alias("origin"), robots_path(F.col("url")).alias("path"))
    match = F.try_element_at(
        F.filter("rules", lambda rule: F.startswith(F.col("path"), rule["path"])), F.lit(1)
    )
    allowed = F.coalesce(match["allow"], F.lit(True))
    if large.isEmpty():
        return row.join(rules, "origin", "left").filter(allowed).select("row.*")
    nodes = stored(rule_nodes(large), "rule-nodes")
    sizes = stored(nodes.groupBy("origin").agg(F.collect_set(F.char_length("prefix")).alias("sizes")), "rule-sizes")
    asked = row.filter("path is not null").select("origin", "path").join(sizes, "origin").distinct()
    denied = stored(_denied(asked, nodes), "denied")
    kept = row.join(rules.filter(F.size("rules") <= many), "origin", "left").filter(allowed)
    return kept.join(denied, ["origin", "path"], "left_anti").select("row.*")
