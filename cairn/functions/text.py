"""Text functions: splitting, normalising and casing of names."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn import fixed


@dataclass(frozen=True)
class NameRules:
    """How a raw name is cut into a compact ``name`` and a ``title`` of qualifiers."""

    substitutions: list[tuple[str, str]] = field(default_factory=lambda: fixed.SUBSTITUTIONS)
    title_words: list[str] = field(default_factory=lambda: fixed.TITLE_WORDS)
    ignore_words: list[str] = field(default_factory=lambda: fixed.IGNORE_WORDS)


def word_text(c: Column) -> Column:
    """Upper-case text in which every run of non-word characters is one space.

    Word characters are letters and digits of any script and the underscore; a combining mark is
    none and parts a word.
    """
    return F.upper(F.regexp_replace(c, r"[^\p{L}\p{N}_]+", " "))


def substitute(c: Column, substitutions: list[tuple[str, str]]) -> Column:
    """Apply regular expressions one after the other."""
    for pattern, replacement in substitutions:
        c = F.regexp_replace(c, "(?U)" + pattern, replacement)
    return c


def name_tokens(c: Column, rules: NameRules = NameRules()) -> Column:
    """Normalised tokens of a name, ignore-words dropped."""
    tokens = F.split(substitute(word_text(c), rules.substitutions), " ")
    return F.filter(tokens, lambda t: (t != "") & ~t.isin(rules.ignore_words))


def is_title_word(token: Column, rules: NameRules = NameRules()) -> Column:
    """Digits and listed qualifiers are title words."""
    return token.rlike(r"(?U)^\d+$") | token.isin(rules.title_words)


def name_and_title(c: Column, rules: NameRules = NameRules()) -> Column:
    """Struct of ``name`` (tokens joined without spaces) and ``title`` (joined by spaces)."""
    tokens = name_tokens(c, rules)
    return F.struct(
        F.array_join(F.filter(tokens, lambda t: ~is_title_word(t, rules)), "").alias("name"),
        F.array_join(F.filter(tokens, lambda t: is_title_word(t, rules)), " ").alias("title"),
    )


def strip(c: Column) -> Column:
    """Trim white space of every kind; ``trim`` alone only takes blanks."""
    return F.btrim(c, F.lit(" \t\n\r\f\v"))


def comma_items(c: Column) -> Column:
    """Trimmed non-empty items of a comma list."""
    items = F.transform(F.split(c, ","), lambda x: strip(x))
    return F.filter(items, lambda x: x != "")


def split_any(c: Column, characters: str = ",;()") -> Column:
    """Split on any of the given characters."""
    return F.split(c, "[" + "".join("\\" + ch for ch in characters) + "]")


def is_ascii(c: Column) -> Column:
    return c.rlike(r"^[\x00-\x7F]*$")


def is_digits(c: Column) -> Column:
    return c.rlike("^[0-9]+$")


def title_case(c: Column, keep_upper: list[str] = fixed.ROMAN_NUMERALS) -> Column:
    """Capital after every non-letter, roman numerals kept upper, white space collapsed.

    Letters are those of any script; ``initcap`` alone would leave the part after a hyphen in lower
    case.
    """
    pieces = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))

    def capital(piece: Column) -> Column:
        # A letter whose capital is two letters begins with one capital and goes on small.
        first = F.upper(F.substring(piece, 1, 1))
        return F.concat(F.substring(first, 1, 1), F.lower(F.substring(first, 2, 9)),
                        F.substring(piece, 2, 1 << 30))

    cased = F.array_join(F.transform(pieces, capital), "")
    tokens = F.filter(F.split(cased, r"\s+"), lambda t: t != "")
    numerals = [n.title() for n in keep_upper]
    return F.array_join(
        F.transform(tokens, lambda t: F.when(t.isin(numerals), F.upper(t)).otherwise(t)), " ")


def slug(c: Column, pattern: str = fixed.SLUG_PATTERN) -> Column:
    """Identifier made of capitals only, stop-words deleted."""
    return F.regexp_replace(F.upper(c), pattern, "")


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _with(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def char_ngrams(c: Column, smallest: int = 2, largest: int = 3) -> Column:
    """All character n-grams of the lower-cased text, repeats kept, shorter ones first."""
    def of_size(text: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - (n - 1))
        return F.when(F.length(text) >= n,
                      F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))
                      ).otherwise(F.array().cast("array<string>"))

    return _with(F.lower(c), lambda text: F.concat(
        *[of_size(text, n) for n in range(smallest, largest + 1)]))


def gram_counts(c: Column, smallest: int = 2, largest: int = 3) -> Column:
    """Array of ``(gram, tf)``: each distinct n-gram of the text with its count."""
    return _with(char_ngrams(c, smallest, largest), lambda grams: F.transform(
        F.array_distinct(grams),
        lambda g: F.struct(g.alias("gram"),
                           F.size(F.filter(grams, lambda x: x == g)).alias("tf"))))
