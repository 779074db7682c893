"""Benchmark decontamination: short test items searched inside long documents.

Items are partitioned by the number of their five-word shingles. An item's sketch holds its
smallest shingle hashes, as many as make a miss impossible: a document that holds three quarters of
``n`` shingles lacks ``n / 4`` of them at most, so of ``n / 4 + hits`` sketched ones it has ``hits``.
``hits`` grows with the size class and keeps chance meetings out. Documents of any length are probed
shingle by shingle with the sketches, and candidates are verified on the shingles' text. Only
DataFrame functions; where the sketches are small Spark broadcasts them, else it shuffles by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.session import staged

SIZE, PERCENT = 5, 75
HITS = [(16, 2), (64, 3), (256, 6), (None, 12)]  # size classes below a number of shingles, and their hits


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _places(words: Column) -> Column:
    """Where a text's shingles begin; fewer than five words are one shingle."""
    return F.sequence(F.lit(0), F.greatest(F.size(words) - SIZE, F.lit(0)))


def _hash(words: Column, at: Column) -> Column:
    # Words past the end are NULL and leave the hash as it is.
    return F.xxhash64(*(F.get(words, at + k) for k in range(SIZE)))


def item_sketches(items: DataFrame) -> DataFrame:
    """``(item, hash, n, hits)``: the sketch of every item of ``items (item, words)``, a row for each hash."""
    hashes = F.sort_array(F.array_distinct(F.transform(_places(F.col("words")), lambda i: _hash(F.col("words"), i))))
    sized = items.select("item", hashes.alias("hashes")).withColumn("n", F.size("hashes"))
    wanted = F.lit(None)
    for below, hits in reversed(HITS):
        wanted = F.lit(hits) if below is None else F.when(F.col("n") < below, hits).otherwise(wanted)
    lacking = F.floor(F.col("n") * (100 - PERCENT) / 100)
    sized = sized.withColumn("hits", F.least(wanted, F.col("n") - lacking))
    return sized.select("item", "n", "hits", F.explode(F.slice("hashes", 1, (lacking + F.col("hits")).cast("int"))).alias("hash"))


def find_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, digest, item_id, n_shared, n_item)`` for each document and item it holds.

    An item is held where 100 * shared shingles >= 75 * the item's shingles. ``docs`` needs ``doc_id``
    and ``text``, ``items`` needs ``item_id`` and ``text``; other columns are not read. Texts without
    words hold nothing and are found nowhere. An item under five words is one shorter shingle, which only
    a text of just those words holds: it is not found inside a longer document. ``digest`` is a hash of the document's text, so that
    documents with NULL or repeated ids are told apart; repeated rows give one answer.
    """
    named = items.select("item_id", F.xxhash64("item_id", "text").alias("item"), _words(F.col("text")).alias("words"))
    named = named.where(F.size("words") > 0).dropDuplicates(["item"])
    sketches = staged(item_sketches(named), "sketches")
    text = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("digest"), F.col("text").cast("string").alias("text"))
    worded = text.select("doc_id", "digest", _words(F.col("text")).alias("words")).where(F.size("words") > 0)
    probes = worded.select("doc_id", "digest", "words", F.explode(_places(F.col("words"))).alias("at")).select(
        "doc_id", "digest", _hash(F.col("words"), F.col("at")).alias("hash"))
    met = (probes.join(sketches, "hash").groupBy("doc_id", "digest", "item", "n", "hits")
           .agg(F.count_distinct("hash").alias("met")).where("met >= hits"))
    asked = staged(met.select(F.col("doc_id").alias("doc"), F.col("digest").alias("asked"), "item", "n"), "asked")
    # Verification: distinct shingles of candidates, as text, that are shingles of the item.
    held = text.join(asked, text["doc_id"].eqNullSafe(asked["doc"]) & (text["digest"] == asked["asked"])).select(
        "doc_id", "digest", "item", "n", _words(F.col("text")).alias("words"))

    def shingles(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.select(*columns, "words", F.explode(_places(F.col("words"))).alias("at")).select(
            *columns, F.array_join(F.slice("words", F.col("at") + 1, SIZE), " ").alias("shingle")).distinct()

    wanted = staged(shingles(named, "item", "item_id"), "shingles")
    shared = (shingles(held, "doc_id", "digest", "item", "n").join(wanted, ["item", "shingle"])
              .groupBy("doc_id", "digest", "item_id", "item", "n").agg(F.count("*").alias("n_shared")))
    return shared.where(F.col("n_shared") * 100 >= F.col("n") * PERCENT).select(
        "doc_id", "digest", "item_id", "n_shared", F.col("n").cast("bigint").alias("n_item"))


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    found = staged(find_contaminated(docs, items).select(
        F.col("doc_id").alias("__doc"), F.col("digest").alias("__digest")).distinct(), "contaminated")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["__doc"])
                     & (F.xxhash64(docs["text"].cast("string")) == found["__digest"]), "left_anti")
