"""Licence scans with a positional index of rare words.

Licence templates are word sequences. The document frequency of every template word over the whole
corpus gives its IDF. Of a file, only the rarest word of each template that it could hold is looked
up; the positions of a template's words, moved back by their place in the template, are then
intersected, and what is left are starts at which the mandatory phrase is verified. The positional
postings stay inside a file's row, so no text is shuffled. Only DataFrame functions.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Base phrases and labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
# Phrases and labels of this library's own.
EXTRA = [
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("apache license version 2 0", "apache-2.0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("creative commons attribution", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("bsd license", "bsd"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("isc license", "isc"),
    ("boost software license", "bsl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


def file_words(text: Column) -> Column:
    """The words of a text in order; A-Z is lower-cased first."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def word_weights(docs: DataFrame, vocabulary: list[str], text_column: str = "text") -> dict[str, float]:
    """IDF of the template words over all documents. The answer has a row a word at most."""
    held = F.array_intersect(file_words(F.col(text_column)), F.array(*map(F.lit, vocabulary)))
    # A word that no template knows stands for the number of documents.
    rows = docs.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("word"))
    counts = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.count("*").alias("n")).collect()}
    total = counts.get("", 0)
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}


def scan_licences(docs: DataFrame, phrases: list[tuple[str, str]] = BASE + EXTRA,
                  text_column: str = "text") -> DataFrame:
    """Replace the text by ``n_words``, ``places`` and ``score``.

    ``places`` lists ``(phrase, label, start, size)`` for every place of every phrase, ``phrase``
    being its number in the list. ``score`` is 1 where a phrase stands, else half of the largest
    share of a phrase's IDF that the file's words cover. A NULL or empty text has no words, no
    places and score 0. All rows and other columns stay; equal rows get equal answers.
    """
    split = [(phrase.split(" "), label) for phrase, label in phrases]
    vocabulary = sorted({w for words, _ in split for w in words})
    weights = word_weights(docs, vocabulary, text_column)
    known = F.array(*map(F.lit, vocabulary))
    base = docs.withColumn("__words", file_words(F.col(text_column))).drop(text_column)
    base = base.withColumn("__held", F.array_intersect("__words", known))
    words, held = F.col("__words"), F.col("__held")
    # Which phrases could stand here, and the rarest word of each: the only words looked up.
    possible = [F.forall(F.array(*map(F.lit, sorted(set(p)))), lambda w: F.array_contains(held, w))
                for p, _ in split]
    base = base.withColumn("__possible", F.when(F.size(held) == 0, F.array().cast("array<int>")).otherwise(
        F.filter(F.array(*(F.when(c, F.lit(i)) for i, c in enumerate(possible))),
                 lambda i: i.isNotNull())))
    # Positional postings of the file: the places of template words, for files with a candidate only.
    posted = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                      lambda x: F.array_contains(known, x["w"]))
    base = base.withColumn("__posted", F.when(F.size("__possible") > 0, posted))

    def places(number: int) -> Column:
        phrase, label = split[number]
        rarest = max(range(len(phrase)), key=lambda j: weights[phrase[j]])
        order = sorted(range(len(phrase)), key=lambda j: (j != rarest, -weights[phrase[j]]))

        def moved(j: int) -> Column:
            return F.transform(F.filter("__posted", lambda x: x["w"] == phrase[j]), lambda x: x["i"] - j)

        starts = functools.reduce(F.array_intersect, map(moved, order))
        exact = F.filter(starts, lambda s: (s >= 0) & (
            F.slice(words, F.greatest(s, F.lit(0)) + 1, len(phrase)) == F.array(*map(F.lit, phrase))))
        rows = F.transform(exact, lambda s: F.struct(
            F.lit(number).alias("phrase"), F.lit(label).alias("label"), s.alias("start"),
            F.lit(len(phrase)).alias("size")))
        return F.when(F.array_contains("__possible", number), rows).otherwise(F.array().cast(rows_type))

    rows_type = "array<struct<phrase:int,label:string,start:int,size:int>>"
    found = F.when(F.size("__possible") == 0, F.array().cast(rows_type)).otherwise(
        F.concat(*(places(n) for n in range(len(split)))))
    share = F.greatest(*(
        sum((F.when(F.array_contains(held, w), weights[w]).otherwise(0.0) for w in sorted(set(p))),
            F.lit(0.0)) / sum(weights[w] for w in set(p)) for p, _ in split))
    return (base.withColumn("places", found)
            .withColumn("n_words", F.size(words).cast("bigint"))
            .withColumn("score", F.when(F.size("places") > 0, 1.0).when(F.size(held) == 0, 0.0)
                        .otherwise(F.round(share / 2, 6)))
            .drop("__words", "__held", "__possible", "__posted"))
