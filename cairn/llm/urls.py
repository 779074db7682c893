"""URL verdicts: rules first, then trust and distrust that spread over the graph of hosts.

Hosts with URLs that a rule allows are trusted seeds, hosts with blocked URLs are distrusted ones.
Trust follows links as personalised PageRank; distrust follows them backwards, from a blocked host to
those that link to it. Hosts are joined by the links of their pages, and a host and the domains above
it vouch for each other. What no rule decides is blocked where the host's distrust exceeds its trust.

Masses are whole numbers, so sums are the same in any order and a repeated task changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.session import staged


@dataclass(frozen=True)
class Rule:
    """Allows or blocks URLs whose host is ``host`` or below it and whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


ALLOW, BLOCK = "allow", "block"
RULES = [Rule(ALLOW, "org", "/"), Rule(BLOCK, "example.org", "/es/"), Rule(BLOCK, "example.org", "/en/1"),
         Rule(ALLOW, "com", "/fr/"), Rule(BLOCK, "com", "/de/")]

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)<a[ \t\r\n\f][^>]*?href[ \t\r\n\f]*=[ \t\r\n\f]*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<> \t\r\n\f]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Longest name that the domain name system knows; a longer host has no domains above it.
LONGEST_NAME = 253
#: Mass of all seeds of a kind, share that a round passes on, rounds, seeds' weight of a domain tie.
MASS, KEEP, ROUNDS = 10 ** 12, 0.85, 20
#: A host is blocked where its distrust is above this many times its trust.
THRESHOLD = 1.0
#: The plan is cut after so many rounds.
CUT = 5


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``; empty for NULL or another text."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """``(text, verdict)`` of the longest rule that fits, NULL without one. For tens of rules."""
    found = F.lit(None).cast("struct<text: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def links(pages: DataFrame) -> DataFrame:
    """``(src, dst, w)``: how many pages of a host link to another host, from ``pages (host, html)``."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.col("html"), F.lit(LINK), 1),
                                         lambda x: F.translate(x, UPPER, LOWER)))
    return (pages.select(F.col("host").alias("src"), F.explode(found).alias("dst")).where("src <> dst AND src <> ''")
            .groupBy("src", "dst").agg(F.count("*").alias("w")))


def domain_ties(hosts: DataFrame) -> DataFrame:
    """``(src, dst, w)``: ties both ways between each ``host`` and the domains above it, of two labels at least."""
    label = F.split("host", r"\.")
    named = hosts.where((F.length("host") <= LONGEST_NAME) & ~F.rlike("host", F.lit(r"^[0-9.:\[\]]+$")))
    ups = named.select("host", label.alias("labels")).where(F.size("labels") > 2).select(
        "labels", F.explode(F.sequence(F.lit(1), F.size("labels") - 2)).alias("k"))

    def below(k: Column) -> Column:
        return F.array_join(F.slice("labels", k, F.size("labels")), ".")

    ties = ups.select(below(F.col("k")).alias("src"), below(F.col("k") + 1).alias("dst")).distinct()
    both = ties.union(ties.select("dst", "src"))
    return both.withColumn("w", F.lit(1).cast("bigint"))


def _whole(x: Column) -> Column:
    return F.floor(x).cast("bigint")


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(kind, host, mass)`` after some rounds of personalised PageRank.

    ``edges (kind, src, dst, share)`` deal a host's mass out, ``seeds (kind, host, mass)`` is where it
    starts and where the rest of it returns in each round. A round is one join and one sum that is
    combined before its shuffle, so a host with very many neighbours is no single task's work.
    """
    rest = seeds.select("kind", "host", _whole(F.col("mass") * F.lit(1 - KEEP)).alias("mass"))
    state = seeds
    for k in range(1, rounds + 1):
        moved = (state.withColumnRenamed("host", "src").join(edges, ["kind", "src"])
                 .select("kind", F.col("dst").alias("host"), _whole(F.col("mass") * F.lit(KEEP) * F.col("share")).alias("mass")))
        state = rest.unionByName(moved).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if k % CUT == 0 or k == rounds:
            state = staged(state, "hosts")
    return state


def host_masses(pages: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(host, trust, distrust)`` for every host that mass reaches, from ``pages (host, html, verdict)``."""
    seen = staged(pages.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("verdict") == ALLOW).alias(ALLOW), F.count_if(F.col("verdict") == BLOCK).alias(BLOCK)), "seen")
    ways = staged(links(pages).union(domain_ties(seen)).groupBy("src", "dst").agg(F.sum("w").alias("w")), "links")
    # Kind 0 is trust, along the links; kind 1 is distrust, against them.
    directed = ways.select(F.lit(0).alias("kind"), "src", "dst", "w").union(
        ways.select(F.lit(1).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    out = directed.groupBy("kind", "src").agg(F.sum("w").alias("total"))
    edges = staged(directed.join(out, ["kind", "src"]).select(
        "kind", "src", "dst", (F.col("w") / F.col("total")).alias("share")), "edges")
    totals = seen.agg(F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK)).first()
    seeds = [seen.where(F.col(name) > 0).select(
        F.lit(kind).alias("kind"), "host", _whole(F.lit(float(MASS)) * (F.col(name) / F.lit(totals[name] or 1))).alias("mass"))
        for kind, name in enumerate((ALLOW, BLOCK))]
    state = propagate(edges, seeds[0].union(seeds[1]), rounds)
    return state.groupBy("host").agg(F.sum(F.when(F.col("kind") == 0, F.col("mass")).otherwise(0)).alias("trust"),
                                     F.sum(F.when(F.col("kind") == 1, F.col("mass")).otherwise(0)).alias("distrust"))


def judge_urls(pages: DataFrame, rules: list[Rule] = RULES, rounds: int = ROUNDS) -> DataFrame:
    """``(page_id, url, host, path, rule, verdict, trust, distrust)`` for each row of ``pages (page_id, url, html)``.

    A NULL URL, or one without ``://``, has an empty host and path. Rules come first, the longest of
    those that fit. Without a rule a page is blocked where its host's distrust exceeds ``THRESHOLD``
    times its trust, and allowed elsewhere: ties, hosts that nothing reaches and empty hosts are
    allowed. A NULL page has no links. Repeated rows count as so many pages and are all returned; an
    empty table gives an empty one. Other columns are not read, whatever their names.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    read = pages.select("page_id", "url", "html", host.alias("host"), path.alias("path"))
    ruled = read.withColumn("found", longest_rule(rules, F.col("host"), F.col("path")))
    masses = staged(host_masses(ruled.select("host", "html", F.col("found.verdict").alias("verdict")), rounds), "masses")
    known = masses.withColumnRenamed("host", "known")
    joined = ruled.drop("html").join(known, F.col("host") == F.col("known"), "left")
    distrusted = F.col("distrust") > F.lit(THRESHOLD) * F.col("trust")
    return joined.select(
        "page_id", "url", "host", "path", F.col("found.text").alias("rule"),
        F.coalesce("found.verdict", F.when(distrusted, BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.coalesce("trust", F.lit(0)).alias("trust"), F.coalesce("distrust", F.lit(0)).alias("distrust"))
