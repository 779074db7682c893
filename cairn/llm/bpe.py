"""Byte-level BPE encoding and decoding.

A text is split into short words by the tokenizer's pattern, and every distinct word is encoded
once for each batch of texts. A word is a contiguous row: the ids of its parts and, between
neighbours, the rank of the merge that would join them. The row is scanned for its smallest rank,
the boundary there is deleted, and the ranks on both sides of the new part are looked up again,
until no rank is left. Rows of about the same length are scanned together in numpy.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# Fixed value: the splitting pattern of byte-level BPE, white space being the Unicode property.
# Letters come first, as most words start with one; no other alternative can match there.
PATTERN = (r" ?\p{L}++| ?\p{N}++|'s|'t|'re|'ve|'m|'ll|'d| ?[^\p{White_Space}\p{L}\p{N}]++"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
CACHE_BYTES = 128 << 20  # of encoded words kept by one Python worker
_NONE = np.int64(1 << 40)


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizer:
    """Ids, merges and special tokens of one vocabulary file."""

    def __init__(self, document: str):
        content = json.loads(document)
        byte_of = printable_bytes()
        vocabulary = content["model"]["vocab"]
        special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        size = 1 + max([*vocabulary.values(), *special.values()])
        self.pieces: list[bytes] = [b""] * size
        for token, i in vocabulary.items():
            self.pieces[i] = bytes(byte_of[c] for c in token)
        for token, i in special.items():
            self.pieces[i] = token.encode()
        self.special = special
        self.split_special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) \
            if special else None
        self.byte_ids = np.array([vocabulary[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        keys = np.array([vocabulary[a] * size + vocabulary[b] for a, b in pairs])
        self.size, order = size, np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.joined = np.array([vocabulary[a + b] for a, b in pairs])
        self.lengths = np.array([len(p) for p in self.pieces])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(self.pieces), np.uint8)
        self.pattern = regex.compile(PATTERN)
        self.clear()

    def clear(self) -> None:
        """Forget all encoded words but the special tokens."""
        self.known: dict[str, int] = {}  # the number of each word in the tables that follow
        self.flat, self.counts, self.held = np.zeros(0, np.int32), np.zeros(0, np.int64), 0
        self._learn([*self.special], np.array([*self.special.values()], np.int32), np.ones(len(self.special), np.int64))

    def _learn(self, words: list[str], flat: np.ndarray, counts: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
        self.begins = np.cumsum(self.counts) - self.counts
        self.held += sum(map(len, words)) + 160 * len(words) + 4 * len(flat)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], _NONE)

    def _merge(self, words: list[bytes]) -> np.ndarray:
        """Encode words of similar length: a row of ids each, then -1.

        ``parts`` holds the ids between a word's boundaries and ``ranks`` those of neighbours.
        """
        width = max(map(len, words))
        parts = np.full((len(words), width + 1), -1)  # a last column of nothing ends every row
        lengths = np.array([len(word) for word in words])
        parts[np.arange(width + 1) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        ranks = np.full((len(words), width + 1), _NONE)
        ranks[:, :-1] = self._rank(parts[:, :-1], parts[:, 1:])
        out = np.full((len(words), width + 1), -1)
        place = np.arange(len(words))
        while len(place):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(place)), at]
            done = least == _NONE
            if done.any():
                out[place[done], :parts.shape[1]] = parts[done]
                parts, ranks, place, at, least = parts[~done], ranks[~done], place[~done], at[~done], least[~done]
                if not len(place):
                    break
            # Delete the boundary: what stands right of the pair moves one place to the left.
            rows, columns = np.arange(len(place)), np.arange(parts.shape[1] - 1)
            moved = columns + (columns > at[:, None])
            parts, ranks = np.take_along_axis(parts, moved, 1), np.take_along_axis(ranks, moved, 1)
            ranks[:, -1] = _NONE
            parts[rows, at] = self.joined[least]
            after = np.where(at + 1 < parts.shape[1], parts[rows, np.minimum(at + 1, parts.shape[1] - 1)], -1)
            ranks[rows, at] = self._rank(parts[rows, at], after)
            before = np.flatnonzero(at > 0)
            left = at[before] - 1
            ranks[before, left] = self._rank(parts[before, left], parts[before, left + 1])
        return out

    def _long(self, word: bytes) -> np.ndarray:
        """One very long word: the same scans, but only equal ranks in one pass over the row.

        Pairs of the smallest rank are joined from the left in the same pass. A joined part never
        makes a pair of a smaller rank than the one just joined, as both its halves existed before.
        """
        parts = self.byte_ids[np.frombuffer(word, np.uint8)].astype(np.int64)
        ranks = self._rank(parts[:-1], parts[1:])
        while len(ranks) and (least := ranks.min()) != _NONE:
            at = np.flatnonzero(ranks == least)
            run = np.concatenate([[True], np.diff(at) > 1])  # of neighbours every second one is joined
            order = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[order % 2 == 0]
            parts[at] = self.joined[least]
            parts = np.delete(parts, at + 1)
            ranks = self._rank(parts[:-1], parts[1:])
        return parts

    def learn(self, words: list[str], rows: int = 4096, wide: int = 256) -> None:
        """Encode distinct words and add them to the table of known words."""
        done: list[tuple[list[str], np.ndarray, np.ndarray]] = []
        raw = [word.encode() for word in words]
        short = sorted((k for k in range(len(raw)) if len(raw[k]) <= wide), key=lambda k: len(raw[k]))
        for low in range(0, len(short), rows):
            some = short[low:low + rows]
            out = self._merge([raw[k] for k in some])
            done.append(([words[k] for k in some], out[out >= 0].astype(np.int32), (out >= 0).sum(axis=1)))
        for k in (k for k in range(len(raw)) if len(raw[k]) > wide):
            ids = self._long(raw[k])
            done.append(([words[k]], ids.astype(np.int32), np.array([len(ids)])))
        if done:
            names, flat, counts = zip(*done, strict=True)
            self._learn([w for some in names for w in some], np.concatenate(flat), np.concatenate(counts))

    def split(self, text: str) -> list[str]:
        """The words of a text; special tokens are words of their own."""
        if not self.split_special:
            return self.pattern.findall(text)
        words, at = [], 0
        for hit in self.split_special.finditer(text):
            words += [*self.pattern.findall(text[at:hit.start()]), hit.group()]
            at = hit.end()
        return words + self.pattern.findall(text[at:] if at else text)

    def encode(self, texts: list[str], cache_bytes: int = CACHE_BYTES) -> list[np.ndarray]:
        """The ids of every text; words are forgotten before more than ``cache_bytes`` are held."""
        texts_words = [self.split(text) for text in texts]
        if self.held > cache_bytes:
            self.clear()
        self.learn(list(set().union(*texts_words).difference(self.known)))
        return [self._gather(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
                for words in texts_words]

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of known words in a row."""
        counts = self.counts[numbers]
        ends = np.cumsum(counts)
        if not len(ends):
            return np.zeros(0, np.int32)
        return self.flat[np.arange(ends[-1]) + np.repeat(self.begins[numbers] - (ends - counts), counts)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids; bytes that are no UTF-8 become replacement characters."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        if not len(ends) or not ends[-1]:
            return ""
        where = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.bytes[where].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _tokenizer(document: str) -> Tokenizer:
    return Tokenizer(document)


def _pieces(batch: pa.RecordBatch, place: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text in one column, one row at least."""
    sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(place)])
    low = 0
    while low < batch.num_rows:
        high = low + max(1, int(np.searchsorted(np.cumsum(sizes[low:low + 4096]), most, "right")))
        yield batch.slice(low, high - low)
        low = high


def encode_documents(docs: DataFrame, tokenizer_json: str, text_column: str = "text",
                     decoded: bool = False, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Add ``ids`` and, on request, ``decoded`` to every document.

    A Python worker keeps about ``cache_bytes`` of encoded words from task to task.

    ``tokenizer_json`` is the content of a byte-level BPE file, which is bounded by its vocabulary.
    A NULL or empty text has no ids and decodes to an empty text. Rows and other columns stay;
    columns called ``ids`` or ``decoded`` are replaced.
    """
    kept = [c for c in docs.columns if c not in ("ids", "decoded")]
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    fields = [f for f in docs.schema.fields if f.name in kept]
    # A text that is carried along anyway is not sent a second time.
    carried = text_column in kept and dict(docs.dtypes)[text_column] == "string"
    place = kept.index(text_column) if carried else len(kept)
    extra = [] if carried else [F.col(text_column).cast("string").alias("__text")]
    rows = docs.select(*(F.col(f"`{c}`") for c in kept), *extra)
    schema = StructType([*fields, StructField("ids", ArrayType(IntegerType()))]
                        + [StructField("decoded", StringType())] * decoded)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared.value)
        for batch in batches:
            for part in _pieces(batch, place):
                texts = [t or "" for t in part.column(place).to_pylist()]
                ids = tokenizer.encode(texts, cache_bytes)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                columns = [*part.columns[:len(kept)],
                           pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))]
                if decoded:
                    columns.append(pa.array([tokenizer.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "ids", *["decoded"] * decoded])

    return rows.mapInArrow(encode, schema)
