"""Secret scans with a trigram inverted index.

Every rule is a regular expression. From it follows a Boolean query over trigrams that any match
must contain; postings ``trigram -> document`` are intersected per rule, and only the documents
that satisfy a rule's query are scanned with its expression. Rules without a mandatory trigram
scan all documents. All of it is DataFrame functions.
"""

from __future__ import annotations

import itertools
import re._constants as tokens
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.session import staged


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``group`` of a match needs ``least`` characters, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base kinds, in the order in which spans with equal starts are listed.
BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
]
# Kinds of this library's own, after the base kinds.
EXTRA = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("cloud_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("chat", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("payment", r"sk_live_[0-9a-zA-Z]{16,}"),
]
RULES = BASE + EXTRA
SPAN = "array<struct<start:int,place:int,kind:string,end:int>>"
_WIDEST = 64  # literal alternatives kept in one clause


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """The Boolean query of an expression: all clauses, each met by one of its sets of trigrams.

    Trigrams are lower case, which widens the query for expressions that mind the case. An empty
    list means that nothing is mandatory.
    """
    clauses = []

    def close(strings: set[str]) -> set[str]:
        if strings and min(map(len, strings)) >= 3:
            sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
            clauses.append(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))
        return {""}

    def literal(item) -> set[str] | None:
        """The few strings that an element can match, or None where they are many."""
        op, arg = item
        if op is tokens.LITERAL:
            return {chr(arg).lower()}
        if op is tokens.IN and all(o is tokens.LITERAL for o, _ in arg) and len(arg) <= 6:
            return {chr(a).lower() for _, a in arg}
        if op is tokens.SUBPATTERN:
            return product(arg[-1])
        if op is tokens.BRANCH:
            parts = [product(branch) for branch in arg[1]]
            return None if None in parts else set().union(*parts)
        if op is tokens.MAX_REPEAT and arg[1] <= 2:
            once = product(arg[2])
            return once and set().union(*({"".join(p) for p in itertools.product(once, repeat=n)}
                                          for n in range(arg[0], arg[1] + 1)))
        return None

    def product(items) -> set[str] | None:
        strings = {""}
        for item in items:
            found = literal(item)
            if found is None or len(strings) * len(found) > _WIDEST:
                return None
            strings = {a + b for a in strings for b in found}
        return strings

    def walk(items) -> None:
        strings = {""}
        for item in items:
            found = literal(item)
            if found is not None and len(strings) * len(found) <= _WIDEST:
                strings = {a + b for a in strings for b in found}
                continue
            strings = close(strings)
            if item[0] is tokens.SUBPATTERN:
                walk(item[1][-1])
            elif item[0] is tokens.MAX_REPEAT and item[1][0] > 0:
                walk(item[1][2])
        close(strings)

    walk(parser.parse(pattern))
    return clauses


def postings(docs: DataFrame, rules: list[Rule], id_column: str, text_column: str) -> DataFrame:
    """The inverted index of the trigrams that the rules ask for: ``(trigram, doc, digest)``.

    A document is known by its id and its text's hash, so NULL and repeated ids stay apart.
    """
    wanted = sorted({t for rule in rules for clause in trigram_query(rule.pattern)
                     for some in clause for t in some})
    low = docs.select(F.col(id_column).alias("doc"), F.xxhash64(text_column).alias("digest"),
                      F.lower(F.coalesce(text_column, F.lit(""))).alias("low"))
    hits = F.filter(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted)),
                    lambda t: t.isNotNull())
    return low.select("doc", "digest", F.explode(hits).alias("trigram"))


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """Intersect the postings of every rule's query: ``(doc, digest, rules)``, one row a document."""
    spark = index.sparkSession
    rows = [(r, c, a, t, len(some), len(query)) for r, rule in enumerate(rules)
            for query in [trigram_query(rule.pattern)] for c, clause in enumerate(query)
            for a, some in enumerate(clause) for t in sorted(some)]
    quoted = ", ".join("({}, {}, {}, '{}', {}, {})".format(
        *r[:3], r[3].replace("\\", "\\\\").replace("'", "\\'"), *r[4:]) for r in rows)
    asked = spark.sql(f"SELECT * FROM VALUES {quoted} AS "
                      "asked(rule, clause, alternative, trigram, need, clauses)")
    whole = (index.join(asked, "trigram")
             .groupBy("doc", "digest", "rule", "clause", "alternative", "need", "clauses")
             .agg(F.count_distinct("trigram").alias("found")).where("found = need"))
    met = (whole.groupBy("doc", "digest", "rule", "clauses")
           .agg(F.count_distinct("clause").alias("met")).where("met = clauses"))
    return met.groupBy("doc", "digest").agg(F.collect_set("rule").alias("rules"))


def rule_spans(text: Column, rule: Rule, place: int) -> Column:
    """All spans of one rule, leftmost and without overlap, in code points, end exclusive.

    The text between matches comes from a split by the same expression, so running lengths of
    gaps and matches give the positions.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"), found.alias("hit"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("part"))
    empty = F.array().cast(SPAN)

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(place).alias("place"),
                        F.lit(rule.kind).alias("kind"), end.alias("end"))
        kept = x["hit"].isNotNull() & (F.length(x["part"]) >= rule.least)
        return F.struct(end.alias("at"), F.when(kept, F.concat(state["spans"], F.array(span)))
                        .otherwise(state["spans"]).cast(SPAN).alias("spans"))

    some = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step,
                       lambda state: state["spans"])
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), some).otherwise(empty)


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES, id_column: str = "doc_id",
                 text_column: str = "text", out: str = "spans") -> DataFrame:
    """Add an array of spans ``(start, place, kind, end)`` to every document.

    Sorted by start, then by the rule's place in the list. A NULL or empty text has no spans, all
    rows and columns stay, repeated rows each get their spans, and an empty table gives an empty
    table. The added column replaces one of the same name; other columns may have any names but
    ``__digest`` and ``__rules``.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    asked = [bool(trigram_query(rule.pattern)) for rule in rules]
    if any(asked):
        # Written first, so that Spark knows their size before it decides to move the texts.
        found = staged(candidates(postings(docs, rules, id_column, text_column), rules).select(
            F.col("doc").alias("__doc"), F.col("digest").alias("__found"),
            F.col("rules").alias("__rules")), "candidates")
        left = docs.withColumn("__digest", F.xxhash64(text_column))
        rows = left.join(found, (left["__digest"] == found["__found"])
                         & left[id_column].eqNullSafe(found["__doc"]), "left").drop("__doc", "__found")
    else:
        rows = docs.withColumns({"__digest": F.lit(0), "__rules": F.array().cast("array<int>")})
    spans = [F.when(F.array_contains("__rules", i), rule_spans(text, rule, i))
             .otherwise(F.array().cast(SPAN)) if asked[i] else rule_spans(text, rule, i)
             for i, rule in enumerate(rules)]
    return (rows.withColumn(out, F.array_sort(F.concat(*spans)))
            .drop("__digest", "__rules"))


def redact(docs: DataFrame, spans: str = "spans", text_column: str = "text",
           mark: str = "[secret]") -> DataFrame:
    """Put ``mark`` in place of every span; overlapping spans become one mark. Drops the spans."""
    text = F.col(text_column)

    def step(state: Column, x: Column) -> Column:
        fresh = x["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, F.greatest(x["start"] - state["at"], F.lit(0)))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"),
                        F.when(fresh, F.concat(state["done"], gap, F.lit(mark)))
                        .otherwise(state["done"]).alias("done"))

    masked = F.aggregate(
        F.col(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("done")), step,
        lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text))))
    return docs.withColumn(text_column, F.when(F.size(spans) > 0, masked).otherwise(text)).drop(spans)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
