"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines: one for every block of text, and empty ones where an element stood
that is never content (menus, footers, adverts, forms, comments) and at the edges of a marked article.
Text lengths, links left out, are summed over a sliding window of lines. The text starts to count
where the sum surges and stops where it dives; what lies between is kept. How much is a surge follows
the page's largest sum. A line in a marked article weighs as much as a surge, all others count too.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80  # characters in a window at which text begins, at least
SHARE = 8  # part of the page's largest window at which text begins
DIVE = 4  # part of a surge below which three lines are no text
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<!--.*?(?:-->|\Z)"
                  r"|<[!?/][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=<>\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_PART = re.compile(r"[a-z0-9]+")
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas audio video".split())
NEVER = frozenset("nav footer aside form menu dialog button select fieldset".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr acronym nobr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
                  "consent notice notices comment comments disqus reply replies respond sidebar menu nav navbar navigation "
                  "breadcrumb breadcrumbs footer share sharing social related recommended newsletter subscribe subscription "
                  "signup login popup modal overlay widget pagination pager masthead toolbar skip gdpr complementary contentinfo search".split())
WHOLE = WORDS | frozenset("ad-container advert-box cookie-notice cookie-banner comment-list comments-area comment-form related-posts "
                          "related-articles share-buttons social-share sharing-buttons newsletter-signup recommended-posts".split())
SAYING = frozenset("no not without with has have is".split())  # first parts of class names about something else


def _unwanted(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is never part of an article. In one, only whole class and id names tell."""
    if name in NEVER or (name == "header" and not inside):
        return True
    has: dict[str, str] = {}
    for key, value in _ATTRIBUTE.findall(attributes):
        has.setdefault(key.lower(), value.strip("\"'").lower())
    names = " ".join(has.get(key, "") for key in ("class", "id", "role"))
    framing = name in ("html", "body", "article", "main")
    if framing and "comment" not in names:
        return False
    if has.get("hidden", "until-found") != "until-found" or has.get("aria-hidden") == "true" or _UNSEEN.search(has.get("style", "")):
        return True
    for named in names.split():
        if inside and not framing:
            if named in WHOLE:
                return True
            continue
        parts = _PART.findall(named)
        if parts and parts[0] not in SAYING and any(p in WORDS or (p == "header" and not inside) for p in parts):
            return True
    return False


def page_lines(page: str) -> tuple[list[str], list[bool], list[int]]:
    """The lines of a page, whether each lies in a marked article and how many characters are in links."""
    lines, marks, links = [], [], []
    text: list[str] = []
    at, depth = 0, 0
    skipped, level = "", 0
    linked, link = 0, False

    def add(some: str) -> None:
        nonlocal linked
        text.append(some)
        if link:
            linked += len(" ".join(some.split()))

    def close() -> None:
        nonlocal linked
        line = " ".join("".join(text).split())
        text.clear()
        if line:
            lines.append(line)
            marks.append(depth > 0)
            links.append(min(linked, len(line)))
        linked = 0

    def gap() -> None:
        lines.extend([""] * WINDOW)
        marks.extend([depth > 0] * WINDOW)
        links.extend([0] * WINDOW)

    for tag in _TAG.finditer(page):
        if tag.start() < at:
            continue
        if not skipped:
            add(html.unescape(page[at:tag.start()]))
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        ends, attributes = bool(tag[1] or tag[4]), tag[3] or tag[6] or ""
        if not name:
            continue
        if name in RAW and not ends and not attributes.endswith("/"):
            stop = re.compile(rf"</{re.escape(name)}\s*>|\Z", re.I).search(page, at)
            at = stop.end()
            if name not in ("svg", "math"):
                close() if not skipped else None
            continue
        if skipped == "p" and name != "p" and name not in INLINE:
            skipped = ""  # any other block ends a paragraph
        if skipped:
            if name == skipped == "p" and not ends:
                skipped = ""
            elif name == skipped:
                level += -1 if ends else 1
                if not level:
                    skipped = ""
            if skipped or ends:
                continue
        if not ends and name not in VOID and not attributes.endswith("/") and _unwanted(name, attributes, depth > 0):
            close()
            gap()
            skipped, level = name, 1
            continue
        if name not in INLINE:
            close()
        if name == "a":
            link = not ends
        if name in ("article", "main"):
            before, depth = depth, max(0, depth + (-1 if ends else 1))
            if not before or not depth:
                gap()
    if not skipped:
        add(html.unescape(page[at:]))
        close()
    return lines, marks, links


def main_text(page: str) -> str:
    """The main text of one page, its blocks joined by single spaces."""
    lines, marks, links = page_lines(page)
    plain = [len(line) - link for line, link in zip(lines, links, strict=True)]
    least = max(SURGE, max((sum(plain[i:i + WINDOW]) for i in range(len(plain))), default=0) // SHARE)
    weights = [max(n, least) if mark and line else n for n, mark, line in zip(plain, marks, lines, strict=True)]
    sums = [sum(weights[i:i + WINDOW]) for i in range(len(weights))]
    if max(sums, default=0) < least:
        least = 1  # nothing surges: a page of a few short lines
    kept: list[str] = []
    doubtful: list[str] = []  # after a dive: text if it surges again before a gap
    inside = False
    for i, line in enumerate(lines):
        ahead = lines[i:i + WINDOW]
        if not any(ahead):
            inside = False
            doubtful.clear()
        elif not line:
            continue
        elif sums[i] >= least and (inside or weights[i]):
            inside = True
            kept.extend([*doubtful, line])
            doubtful.clear()
        elif inside:
            dives = bool(doubtful) or not sums[i] or (len(ahead) == WINDOW and all(ahead) and sums[i] * DIVE < least)
            (doubtful if dives else kept).append(line)
    return " ".join(kept)


def extract_pages(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """Replace the page's markup by its main text.

    A NULL or empty page has an empty text. Rows and other columns stay, a column of the new name is
    replaced, and equal pages get equal texts.
    """
    kept = [c for c in pages.columns if c not in (out, html_column)]
    schema = pages.select(*(F.col(f"`{c}`") for c in kept), F.lit("").alias(out)).schema

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(page.as_py() or "") for page in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*kept, out])

    return pages.select(*(F.col(f"`{c}`") for c in kept), F.col(html_column).cast("string").alias("__html")).mapInArrow(
        extract, schema)
