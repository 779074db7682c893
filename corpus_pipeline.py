"""From raw documents to tokens: language, copies, benchmark leaks, secrets, token ids.

Every stage takes the documents its predecessor kept, whole, and returns documents with the same
columns; the last one adds token ids. Between stages the documents are written to the shared folder
and read back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import bpe, decontaminate, language, neardup, rows, secrets
from cairn.llm.queries import QUERIES, VOCABULARY, prepare
from cairn.session import staged

#: A text whose shortest code is longer than its own bytes is in none of the learned languages.
MOST_BITS = 8.0
#: Encoded words that a Python worker keeps: it lives on through stages that need their memory.
TOKEN_CACHE = 32 << 20


def _carried(docs: DataFrame) -> DataFrame:
    """The text and all else as one column, so that no column meets one that an operator adds."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"), "doc_id", "text")


def _own(name: str) -> Column:
    return (F.col("text") if name == "text" else F.col(f"row.`{name}`")).alias(name)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in a learned language; a missing ``lang`` is filled in.

    Texts without a letter go, and so do those that no language model shortens. Where no document
    has a language to learn from, only texts without a letter go.
    """
    prepare(spark)
    model = language.learn(docs)
    if model is None:
        return docs.where(F.regexp_like("text", F.lit(r"\p{L}")))
    found = language.identify(_carried(docs).drop("doc_id"), model)
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("bits_per_byte") <= MOST_BITS))
    return kept.select(*(F.coalesce("row.lang", "lang_pred").alias(c) if c == "lang" else _own(c)
                         for c in docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id from each group of near copies, and one of repeated rows.

    Documents without an id are compared with none; of those with equal texts one stays.
    """
    prepare(spark)
    found = staged(neardup.near_duplicates(docs).select("doc_id", "kept"), "copies")
    kept = rows.without(docs, found.where("NOT kept").select("doc_id"), "doc_id")
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    return kept.withColumn("__digest", F.xxhash64("text")).dropDuplicates(["doc_id", "__digest"]).drop("__digest")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no benchmark item."""
    prepare(spark)
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents; secrets in them give way to a mark, and ``n_chars`` follows the text."""
    prepare(spark)
    found = secrets.find_secrets(_carried(docs)).withColumn("hit", F.size("spans") > 0)
    masked = secrets.redact(found)
    size = F.when(F.col("hit"), F.length("text").cast("bigint")).otherwise(F.col("row.n_chars")).alias("n_chars")
    return masked.select(*(size if c == "n_chars" else _own(c) for c in docs.columns))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the token ids of every text as ``ids`` and their number as ``n_tokens``."""
    prepare(spark)
    done = bpe.encode_documents(_carried(docs).drop("doc_id"), Path(VOCABULARY).read_text(encoding="utf-8"),
                                cache_bytes=TOKEN_CACHE)
    own = [_own(c) for c in docs.columns if c not in ("ids", "n_tokens")]
    return done.select(*own, F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("tokens", encode_tokens),
]
#: SQL has no code lengths of byte contexts and no token merges; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES["pipeline"] = run
