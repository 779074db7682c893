"""Quality rules whose thresholds follow the corpus.

Every document gets a few text statistics. For each language and source a mergeable quantile
sketch of each rate gives the quartiles, and a document fails where it lies far above the upper
quartile of its own group. A sketch is a histogram of fixed width: it merges by addition, gives the
same answer in any order, and is combined map-side, so a hot source costs a few rows per task.
Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import staged

SPACE = r"[\x20\x09-\x0D]"
RATES = ("symbol_rate", "line_rate", "repeat_rate")
# A rate below its floor is ordinary text in every group, whatever the group's quartiles are.
FLOORS = {"symbol_rate": 0.05, "line_rate": 0.3, "repeat_rate": 0.3}
BINS = 1000
REACH = 6.0  # interquartile ranges above the upper quartile


_FEW = 32  # repeated windows up to which each place is looked up in their list


def _repeat_places() -> Column:
    """Where the windows stand that occur twice or more, given ``__windows`` and ``__twice``.

    A short list of repeated windows is searched for each place; otherwise the places are sorted by
    window and compared with their neighbours. Both give the same places.
    """
    windows, twice = F.col("__windows"), F.col("__twice")
    looked = F.filter(F.sequence(F.lit(0), F.size(windows) - 1),
                      lambda i: F.array_contains(twice, F.get(windows, i)))
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = F.filter(F.arrays_zip(placed.alias("a"), F.slice(placed, 2, F.size(placed)).alias("b")),
                     lambda x: x["a"]["h"] == x["b"]["h"])
    sides = F.concat(F.transform(pairs, lambda x: x["a"]["i"]), F.transform(pairs, lambda x: x["b"]["i"]))
    return (F.when(F.size(twice) == 0, F.array().cast("array<int>"))
            .when(F.size(twice) <= _FEW, looked).otherwise(F.array_distinct(sides)))


def text_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Replace the text by ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    ``n_repeat_words`` counts the words inside a three-word window that stands twice or more, its
    first place included. A NULL or empty text has zeros everywhere. Columns of those names are
    replaced. Every step is a column of its own, so that none is computed twice.
    """
    word = F.lit(r"[^\x20\x09-\x0D]")
    hashes = F.transform(F.sequence(F.lit(0), F.size("__words") - 3), lambda i: F.xxhash64(
        F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)))
    ahead = F.filter("__sorted", lambda h, i: h == F.get("__sorted", i + 1))
    covered = F.concat("__at", F.transform("__at", lambda i: i + 1), F.transform("__at", lambda i: i + 2))
    base = (docs.withColumn("__text", F.coalesce(F.col(text_column).cast("string"), F.lit(""))).drop(text_column)
            .withColumn("__words", F.filter(F.split("__text", SPACE + "+"), lambda w: w != ""))
            .withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: F.regexp_like(x, word)))
            .withColumn("__windows", F.when(F.size("__words") >= 3, hashes).otherwise(F.array().cast("array<bigint>")))
            .withColumn("__sorted", F.sort_array("__windows"))
            .withColumn("__twice", F.array_distinct(ahead))
            .withColumn("__at", _repeat_places()))
    return base.withColumns({
        "n_words": F.size("__words").cast("bigint"),
        "word_chars": F.length(F.array_join("__words", "")).cast("bigint"),
        "n_symbols": F.length(F.regexp_replace("__text", r"[^#*$%&|<>]+", "")).cast("bigint"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
        "__n_lines": F.size("__lines"),
        "n_repeat_words": F.size(F.array_distinct(covered)).cast("bigint"),
    }).drop("__text", "__words", "__lines", "__windows", "__sorted", "__twice", "__at").withColumns({
        "symbol_rate": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        # One repeated line, a motto or a heading, is no sign of anything.
        "line_rate": F.greatest(F.col("n_dup_lines") - 1, F.lit(0)) / F.greatest(F.col("__n_lines"), F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
    }).drop("__n_lines")


def group_sketches(stats: DataFrame, groups: list[str]) -> DataFrame:
    """Quantile sketches ``(groups, rate, bin, n)``: counts in ``BINS`` equal bins of every rate.

    Sketches of two loads merge by adding their counts, so old text need not be read again; a
    quantile is off by one bin's width at most, whatever the number of documents.
    """
    rates = F.array(*(F.struct(F.lit(r).alias("rate"), F.floor(F.col(r) * BINS).cast("int").alias("bin"))
                      for r in RATES))
    return (stats.select(*groups, F.explode(rates).alias("x"))
            .groupBy(*groups, F.col("x.rate").alias("rate"), F.col("x.bin").alias("bin"))
            .agg(F.count("*").alias("n")))


def merge_sketches(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Add up the sketches of several loads."""
    return sketches.groupBy(*groups, "rate", "bin").agg(F.sum("n").alias("n"))


def thresholds(sketches: DataFrame, groups: list[str], reach: float = REACH) -> DataFrame:
    """The highest rate each group lets pass: upper quartile + ``reach`` interquartile ranges.

    The range counts as an eighth of the quartile and ten bins at least, so that a group whose
    documents hardly differ does not lose those that differ a little.
    """
    group = Window.partitionBy(*groups, "rate")
    upto = F.sum("n").over(group.orderBy("bin"))
    total = F.sum("n").over(group)
    low, high = (F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bin"))) for k in (1, 3))
    bins = (sketches.withColumn("upto", upto).withColumn("total", total)
            .groupBy(*groups, "rate").agg((high + 1 + reach * F.greatest(high - low, high / 8, F.lit(10.0))).alias("most")))
    return bins.groupBy(*groups).agg(*(
        F.greatest(F.max(F.when(F.col("rate") == r, F.col("most"))) / BINS, F.lit(FLOORS[r]))
        .alias(f"most_{r}") for r in RATES))


def judge(docs: DataFrame, groups: tuple[str, ...] = ("lang", "source"), text_column: str = "text",
          reach: float = REACH) -> DataFrame:
    """Judge every document: its statistics, ``base_failed`` and ``kept``; the text is left out.

    ``base_failed``: under 50 words, or over half of the words repeated. ``kept``: not base_failed
    and no rate above its group's threshold. NULL languages and sources are groups of their own. All
    rows stay, an empty table gives an empty table, equal rows get equal verdicts.
    """
    stats = staged(text_statistics(docs, text_column), "quality")
    limits = staged(thresholds(group_sketches(stats, list(groups)), list(groups), reach)
                    .withColumnsRenamed({g: f"__{g}" for g in groups}), "thresholds")
    same = [stats[g].eqNullSafe(limits[f"__{g}"]) for g in groups]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    above = [F.col(r) > F.col(f"most_{r}") for r in RATES]
    return (stats.join(limits, same, "left").drop(*(f"__{g}" for g in groups))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & ~F.coalesce(above[0] | above[1] | above[2], F.lit(False))))
