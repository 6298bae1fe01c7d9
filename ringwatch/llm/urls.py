"""Verdicts on URLs by pattern rules that are looked up by their rarest literal token.

A rule is written ``host/path`` with ``*`` for any run of characters; it fits its host, all
subdomains of it and every path that starts with its path. Each rule is filed under one of its literal
tokens, the one that the fewest URLs of the table hold. A URL's tokens fetch the rules filed under
them, and only those rules run their regular expression. The longest fitting rule wins.

The index is one map literal whose size is bounded by the rule list, so judging is a narrow pass of
built-in functions over the pages: no shuffle, whatever the number of pages.

Cases: a null URL or one without ``://`` has an empty host and path and no rule, verdict ``allow``;
repeated rows are judged each on its own; equal lengths go to the rule listed first; an empty table
gives an empty result; further columns of the input are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import pick

#: The index is a literal in the plan, so the rule list has a bound.
MAX_RULES = 20_000


@dataclass(frozen=True)
class Rule:
    text: str       # host/path, with * as a wildcard
    verdict: str    # allow or block
    named: bool = True  # False: decides where no named rule does, and stays unnamed in the result

    @property
    def regex(self) -> str:
        host, slash, path = self.text.partition("/")
        host = "[^/]*".join(re.escape(x) for x in host.split("*"))
        path = ".*".join(re.escape(x) for x in path.split("*"))
        return rf"^(?:[^/]*\.)?{host}" + (f"/{path}" if slash else "(?:/|$)")

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that stand whole in every URL that fits: closed on both sides, and not by a ``*``."""
        host, slash, path = self.text.partition("/")
        found = []
        for side, end in ((host, "/"), (path if slash else "", "*")):
            for m in re.finditer(r"[A-Za-z0-9]+", side):
                before = side[m.start() - 1] if m.start() else "/"
                after = side[m.end()] if m.end() < len(side) else end
                if "*" not in (before, after):
                    found.append(m.group())
        return list(dict.fromkeys(found))


# The rules every table is judged by.
HOST_RULES = [Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"),
              Rule("org/fr/", "allow")]

# Sites blocked where no rule above fits.
SPAM_RULES = [Rule("cheap-pills.*", "block", False), Rule("casino-win.*", "block", False),
              Rule("spam-farm.*", "block", False), Rule("free-prizes.*", "block", False)]


def _host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(
        F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _tokens(spot: Column) -> Column:
    return F.array_distinct(F.filter(F.split(spot, "[^A-Za-z0-9]+"), lambda t: t != ""))


def parts(pages: DataFrame) -> DataFrame:
    """page_id, host and path of every URL."""
    host, path = _host_path(F.col("url"))
    return pick(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))


def token_counts(split_pages: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """In how many URLs each literal token of the rules stands: one aggregate over all pages."""
    wanted = sorted({t for r in rules for t in r.tokens})
    known = F.array(*[F.lit(t) for t in wanted]) if wanted else F.array().cast("array<string>")
    seen = split_pages.select(
        F.explode(F.array_intersect(_tokens(F.concat("host", "path")), known)).alias("token"))
    counts = {t: 0 for t in wanted}
    counts.update((row["token"], row["n"]) for row in seen.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect())
    return counts


def index(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Places in ``rules`` by the token each rule is filed under; ``""`` holds rules without one."""
    filed: dict[str, list[int]] = {}
    for i, rule in enumerate(rules):
        token = min(rule.tokens, key=lambda t: (counts[t], -len(t), t), default="")
        filed.setdefault(token, []).append(i)
    return filed


def judge(pages: DataFrame, rules: list[Rule] = HOST_RULES + SPAM_RULES) -> DataFrame:
    """page_id, host, path, rule (null if none is named), verdict, and matched (the text of what decided)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    split_pages = parts(pages)
    filed = index(rules, token_counts(split_pages, rules))
    place = {t: F.array(*[F.lit(i) for i in ids]) for t, ids in filed.items()}
    lookup = F.create_map(*[x for t in sorted(place) for x in (F.lit(t), place[t])])
    # Rank of a rule: named ones first, then the longer, then the earlier.
    order = sorted(range(len(rules)), key=lambda i: (not rules[i].named, -len(rules[i].text), i))
    rank = {i: k for k, i in enumerate(order)}

    def field(name: str) -> Column:
        return F.get(F.array(*[F.lit(getattr(r, name)) for r in rules]), F.col("best"))

    none = F.array().cast("array<int>")
    keys = F.concat(_tokens(F.col("spot")), F.array(F.lit("")))
    fetched = F.flatten(F.transform(keys, lambda t: F.coalesce(F.try_element_at(lookup, t), none)))
    patterns = F.array(*[F.lit(r.regex) for r in rules])
    ranks = F.array(*[F.lit(rank[i]) for i in range(len(rules))])
    fits = F.filter(fetched, lambda i: F.rlike(F.col("spot"), F.get(patterns, i)))
    best = F.get(F.array(*[F.lit(i) for i in order]), F.array_min(F.transform(fits, lambda i: F.get(ranks, i))))
    judged = split_pages.withColumn("spot", F.concat("host", "path")).withColumn("best", best)
    return judged.select(
        "page_id", "host", "path", F.when(field("named"), field("text")).alias("rule"),
        F.coalesce(field("verdict"), F.lit("allow")).alias("verdict"), field("text").alias("matched"))
