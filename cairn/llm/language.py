"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to three bytes long with the counts of what followed.
A byte costs ``-log2`` of its share in the longest known context; where it was never seen there,
the context's escape is paid (method C: as likely as the number of distinct followers) and the next
shorter context is asked, down to eight bits for any byte. A-Z is lower-cased, so that a text in
capitals is no foreign one. The trees are frozen after learning, each by itself and with all its
contexts, so no language's code depends on which others there are, and
a text has the language in which its exact code is shortest.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.words import text_bytes

SAMPLE = 2000  # documents learned from in each language, about; chosen by their text's hash
UNKNOWN = "und"
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_LETTER = regex.compile(r"\p{L}")
_PIECE = 1 << 17


def held_out(doc_id: Column, modulus: int = 5) -> Column:
    """Rows that are not learned from: a checksum of the id; rows without an id are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == 0, F.lit(True))


def _grams(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte with the three before it, A-Z in lower case; three line ends stand before every text."""
    n, texts = len(raw), len(offsets) - 1
    padded = np.full(n + 3 * texts, 10, np.uint32)
    shift = 3 * (np.searchsorted(offsets, np.arange(n), "right"))
    padded[np.arange(n) + shift] = _FOLD[raw]
    at = np.arange(n) + shift
    return (padded[at - 3] << np.uint32(24)) | (padded[at - 2] << np.uint32(16)) | (padded[at - 1] << np.uint32(8)) | padded[at]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang in batch.column("lang").unique().to_pylist():
            rows = batch.filter(pa.compute.equal(batch.column("lang"), lang))
            for at in range(0, rows.num_rows, 256):
                grams, n = np.unique(_grams(*text_bytes(rows.slice(at, 256).column("text"))), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n, pa.int64())],
                    names=["lang", "gram", "n"])


@dataclass
class Order:
    """Code lengths of one language's known sequences of one length, and the escapes of their contexts."""

    keys: np.ndarray
    cost: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray


@dataclass
class Model:
    """The languages and the four orders of each; a missing sequence costs its escape and its shorter form."""

    languages: list[str]
    orders: list[list[Order]]

    def costs(self, grams: np.ndarray, k: int) -> np.ndarray:
        """The code length of each last byte of some four-byte sequences in one language."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for width in (4, 3, 2, 1):
            order = self.orders[k][width - 1]
            some = grams[left] & np.uint32((1 << (8 * width)) - 1)
            found, row = _lookup(order.keys, some)
            out[left[found]] += order.cost[row[found]]
            left, some = left[~found], some[~found]
            known, row = _lookup(order.contexts, some >> np.uint32(8))
            out[left[known]] += order.escape[row[known]]
        out[left] += 8.0
        return out


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    row = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[row] == wanted, row


def freeze(gram: np.ndarray, n: np.ndarray) -> list[Order]:
    """Freeze one language's counts of four-byte sequences into code lengths for every order."""
    orders = []
    for width in (1, 2, 3, 4):
        keys, inverse = np.unique(gram & np.uint32((1 << (8 * width)) - 1), return_inverse=True)
        number = np.bincount(inverse, n, len(keys))
        context = keys >> np.uint32(8)
        new = np.concatenate([[True], context[1:] != context[:-1]])
        first = np.flatnonzero(new)
        distinct = np.diff(np.append(first, len(keys)))
        whole = np.add.reduceat(number, first) + distinct
        cost = -np.log2(number / whole[np.cumsum(new) - 1])
        orders.append(Order(keys, cost.astype(np.float32), context[first], (-np.log2(distinct / whole)).astype(np.float32)))
    return orders


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from rows of ``docs (text, lang)``; None where no row has both.

    About ``sample`` different texts are taken from each language, all of them where it has no more, and
    all their sequences are kept, so the model's size follows the number of languages and not that of the
    documents. A text counts once for a language, however many copies it has there: copies neither
    crowd out other texts nor fill the sample.
    """
    rows = docs.select("text", "lang", F.xxhash64("text").alias("digest")).where("text IS NOT NULL AND lang IS NOT NULL")
    texts = rows.groupBy("lang", "digest").agg(F.count("*").alias("n"))
    sizes = texts.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not sizes:
        return None
    share = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], 1.0 if r["n"] <= sample else sample / r["n"])))
    # Another hash than that of the digest, which equal texts share.
    part = F.pmod(F.xxhash64(F.lit("sample"), "digest"), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000

    def tree(some: pd.DataFrame) -> pd.DataFrame:
        orders = freeze(some["gram"].to_numpy().astype(np.uint32), some["n"].to_numpy().astype(np.float64))
        return pd.DataFrame({"lang": [some["lang"].iloc[0]], "tree": [pickle.dumps([(o.keys, o.cost, o.contexts, o.escape) for o in orders])]})

    trees = (rows.where(part).dropDuplicates(["lang", "digest"]).select("text", "lang").mapInArrow(_count_batches, "lang string, gram bigint, n bigint")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
             .groupBy("lang").applyInPandas(tree, "lang string, tree binary").collect())
    if not trees:
        return None
    trees.sort(key=lambda r: r["lang"])
    return Model([r["lang"] for r in trees], [[Order(*o) for o in pickle.loads(r["tree"])] for r in trees])


def text_costs(model: Model, column: pa.Array) -> np.ndarray:
    """The code length in bits of every text in every language."""
    raw, offsets = text_bytes(column)
    out = np.zeros((len(column), len(model.languages)))
    step = max(1024, _PIECE)
    for low in range(0, len(raw), step):
        high = min(len(raw), low + step)
        # Three bytes of context come from before the piece, unless a text begins there.
        begin = max(0, low - 3)
        inner = np.unique(np.concatenate([[begin], offsets[(offsets > begin) & (offsets < high)], [high]]))
        grams, place = np.unique(_grams(raw[begin:high], inner - begin)[low - begin:], return_inverse=True)
        text = np.searchsorted(offsets, np.arange(low, high), "right") - 1
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        for k in range(len(model.languages)):
            out[text[first], k] += np.add.reduceat(model.costs(grams, k)[place], first)
    return out


def identify(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``bits_per_byte`` to every document.

    ``score`` is the probability of the predicted language if all were equally likely before. A NULL
    text or one without a letter is ``und`` with score 0, as is every text where nothing was learned.
    Equal code lengths go to the first name. Columns of the three names are replaced.
    """
    added = ["lang_pred", "score", "bits_per_byte"]
    kept = [c for c in docs.columns if c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # A text that is carried along anyway is not sent a second time.
    carried = text_column in kept and dict(docs.dtypes)[text_column] == "string"
    place = kept.index(text_column) if carried else len(kept)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                text = part.column(place)
                letters = np.array([bool(t) and _LETTER.search(t) is not None for t in text.to_pylist()], bool)
                names, score, rate = [UNKNOWN] * len(text), np.zeros(len(text)), np.zeros(len(text))
                if known is not None:
                    bits = text_costs(known, text)
                    least = bits.min(axis=1)
                    sizes = np.maximum([len(t.as_buffer()) if t.is_valid else 0 for t in text], 1)
                    score = np.where(letters, 1 / np.exp2(least[:, None] - bits).sum(axis=1), 0.0)
                    rate = np.where(letters, least / sizes, 0.0)
                    names = [known.languages[k] if ok else UNKNOWN
                             for k, ok in zip(bits.argmin(axis=1), letters, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(kept)], pa.array(names, pa.string()), pa.array(score, pa.float64()),
                     pa.array(rate, pa.float64())], names=[*kept, *added])

    schema = docs.select(*(F.col(f"`{c}`") for c in kept), F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"),
                         F.lit(0.0).alias("bits_per_byte")).schema
    extra = [] if carried else [F.col(text_column).cast("string").alias("__text")]
    return docs.select(*(F.col(f"`{c}`") for c in kept), *extra).mapInArrow(predict, schema)
