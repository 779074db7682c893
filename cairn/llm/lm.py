"""Language-model scores from a log-frequency Bloom filter.

Counts of words and of word pairs over all training documents are quantised to powers of two; a
sequence with level ``q`` is put into a Bloom filter under the levels 1 to ``q``. The filter is built
in segments, each from the sequences whose hash falls into its range and as large as what it stores:
every word and every pair. Counts meet once, packed and dealt by segment, and the task that sums a
segment's counts also fills its bits. Workers find a count again by asking for level after level until
one is missing, and a pair's probability is smoothed with that of its second word. A filter within a
bound goes to every worker. A larger one stays a table of segments, to which the distinct sequences
of many documents at a time are shuffled; the scores are the same.

The exact word counts stay a table. The most frequent words, a fixed number, go to the workers as an
array; only the other words of a document are shuffled to meet their counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import words as w
from cairn.session import staged

SHARE = 1 << 21  # bytes of text, about, whose sequences share a segment of the filter
SENT = 128 << 20  # bytes of a filter that is sent to every worker, at most; a larger one stays a table
BITS, PROBES = 8, 4  # bits and probes for each stored level
BLOCKS = 64  # segments of the table that are asked together, at most
BUCKET = 4 << 20  # bytes of text, about, that ask the table together
HEAD = 1 << 17  # words whose exact counts go to every worker
PRIOR = 20.0  # weight of a word's own probability in that of a pair
FLUSH = 2 << 20  # tokens counted together in a task
END = np.uint64(0x7C15D1CE4E5B9F4A)
START = np.uint64(0x133111EB9E3779B9)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_LEVEL = np.uint64(0x165667B19E3779F9)


def tokens(column: pa.Array) -> w.Words:
    """Hashes of each text's words and one end."""
    found = w.word_hashes(column)
    ends = found.ends + np.arange(len(found.ends))
    out = np.full(ends[-1], END)
    inner = np.ones(len(out), bool)
    inner[ends[1:] - 1] = False
    out[inner] = found.hashes
    return w.Words(out, ends)


def pair_hashes(some: w.Words) -> np.ndarray:
    """Hash of each token with the one before it; a start stands before every text."""
    before = np.empty_like(some.hashes)
    before[1:] = some.hashes[:-1]
    before[some.ends[:-1]] = START
    return w.mix(before * _PAIR + some.hashes)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _segment(h: np.ndarray, segments: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)


def pack(keys: np.ndarray) -> bytes:
    """Sorted hashes as their first one and gaps of as many bytes as the largest needs."""
    if not len(keys):
        return b""
    gaps = np.diff(keys)
    width = (int(gaps.max(initial=0)).bit_length() + 7) // 8 or 1
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + np.ascontiguousarray(
        gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    """The hashes of ``pack``."""
    if not packed:
        return np.zeros(0, np.uint64)
    width = packed[0]
    first, gaps = np.frombuffer(packed, "<u8", 1, 1), np.frombuffer(packed, np.uint8, -1, 9).reshape(-1, width)
    wide = np.zeros((len(gaps), 8), np.uint8)
    wide[:, :width] = gaps
    return np.cumsum(np.concatenate([first, wide.view("<u8").ravel()]), dtype=np.uint64)


def _cuts(sorted_: np.ndarray) -> list[int]:
    """Where each value of a sorted array begins, and its end."""
    new = np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1
    return [0, *new.tolist(), len(sorted_)] if len(sorted_) else []


def _counter(segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], []]

        def flush() -> Iterator[pa.RecordBatch]:
            for kind in (0, 1):
                if held[kind]:
                    keys, n = np.unique(np.concatenate(held[kind]), return_counts=True)
                    held[kind].clear()
                    segment = _segment(keys, segments)
                    cuts = _cuts(segment)
                    for at in range(0, len(cuts) - 1, 256):
                        some = cuts[at:at + 257]
                        pairs = list(zip(some, some[1:], strict=False))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(segment[some[:-1]]), pa.array(np.full(len(pairs), kind, np.int8)),
                             pa.array([pack(keys[a:b]) for a, b in pairs], pa.binary()),
                             pa.array([n[a:b].astype("<u4").tobytes() for a, b in pairs], pa.binary())],
                            names=["segment", "kind", "h", "n"])

        size = 0
        for part in _parts(batches):
            some = tokens(part.column("text"))
            held[0].append(some.hashes)
            held[1].append(pair_hashes(some))
            size += len(some.hashes)
            if size >= FLUSH:
                yield from flush()
                size = 0
        yield from flush()
    return run


def _summed(rows: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of one kind in a segment, and their counts."""
    own = rows.filter(pc.equal(rows.column("kind"), kind))
    keys = [unpack(x) for x in own.column("h").to_pylist()]
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.concatenate(keys)
    n = np.concatenate([np.frombuffer(x, "<u4") for x in own.column("n").to_pylist()]).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.array(_cuts(key)[:-1])
    return key[first], np.add.reduceat(n, first)


def _bits_of(h: np.ndarray, level: np.ndarray | int, size: np.ndarray | int) -> np.ndarray:
    """The bits of each sequence for one level in a segment of ``size`` bits, a column for each probe."""
    low = np.uint64(0xFFFFFFFF)
    x = w.mix(h + np.asarray(level, np.uint64) * _LEVEL)
    spread = ((x & low)[:, None] + ((x >> np.uint64(32)) | np.uint64(1))[:, None] * np.arange(PROBES, dtype=np.uint64)) & low
    return ((spread * np.asarray(size, np.uint64).reshape(-1, 1)) >> np.uint64(32)).astype(np.int64)


def _fill(rows: pa.Table) -> pa.Table:
    """One segment: its bits, and the exact counts of the words in it."""
    (word, n), (pair, m) = _summed(rows, 0), _summed(rows, 1)
    keys, level = np.concatenate([word, pair]), np.floor(np.log2(np.concatenate([n, m])) + 1e-9).astype(int) + 1
    bits = np.zeros(8 * -(-int(level.sum()) * BITS // 8), np.uint8)
    for q in range(1, int(level.max()) + 1):
        bits[_bits_of(keys[level >= q], q, len(bits)).ravel()] = 1
    return pa.table({"segment": pa.array([rows.column("segment")[0].as_py()]), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()]),
                     "words": pa.array([len(word)]), "total": pa.array([int(n.sum())]),
                     "h": pa.array([pack(word)], pa.binary()), "n": pa.array([n.astype("<i8").tobytes()], pa.binary())})


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for h, n in zip(batch.column("h"), batch.column("n"), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(unpack(h.as_py()).view(np.int64)), pa.array(np.frombuffer(n.as_buffer(), "<i8"))],
                                             names=["h", "n"])


@dataclass
class Filter:
    """The Bloom filter, or some segments of it, with the sizes of the training corpus.

    ``bits`` holds segment after segment behind one byte of zeros, where segments without a sequence
    point; ``starts`` and ``sizes``, in bits, are those of the segments from ``first`` on.
    """

    bits: np.ndarray | None  # None where they are a table
    starts: np.ndarray | None
    sizes: np.ndarray | None
    segments: int
    total: int
    distinct: int
    first: int = 0

    def holding(self, segments: Iterator[tuple[int, bytes]], first: int, number: int) -> Filter:
        """This filter with the bits of ``number`` segments from ``first`` on."""
        starts, sizes, held = np.zeros(number, np.int64), np.full(number, 8, np.int64), [np.zeros(1, np.uint8)]
        end = 8
        for segment, bits in segments:
            held.append(np.frombuffer(bits, np.uint8))
            starts[segment - first], sizes[segment - first] = end, 8 * len(held[-1])
            end += 8 * len(held[-1])
        return Filter(np.concatenate(held), starts, sizes, self.segments, self.total, self.distinct, first)

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The highest level under which each sequence is found, asking from 1 up; 0 for none.

        A sequence that occurs often has many levels, so each is asked for once.
        """
        h, back = np.unique(h, return_inverse=True)
        out = np.zeros(len(h), np.int64)
        asked, level = np.arange(len(h)), 0
        place = _segment(h, self.segments) - self.first
        while len(asked):
            level += 1
            own = place[asked]
            at = self.starts[own][:, None] + _bits_of(h[asked], level, self.sizes[own])
            there = ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
            asked = asked[there]
            out[asked] = level
            if level == 63:
                break
        return out[back]

    def counts(self, h: np.ndarray) -> np.ndarray:
        """The count that each level stands for: 1 for the first, then the middle of 2**q."""
        level = self.levels(h).astype(np.float64)
        return np.where(level < 2, level, 1.5 * 2.0 ** (level - 1) - 0.5)

    def score(self, some: w.Words) -> np.ndarray:
        """log10 of the probability of each text."""
        word = self.counts(some.hashes)
        alone = (word + 0.1) / (self.total + 0.1 * (self.distinct + 1))
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[some.ends[:-1]] = 0
        texts = max(1.0, float(self.counts(np.array([END]))[0]))  # as many starts as ends
        before[some.ends[:-1]] = texts
        both = self.counts(pair_hashes(some))
        chance = (both + PRIOR * alone) / (np.maximum(before, both) + PRIOR)
        # Quantised counts are no exact counts: no token is certain.
        return np.add.reduceat(np.log10(np.minimum(chance, 1.0)), some.ends[:-1]) if len(some.hashes) else np.zeros(0)


@dataclass
class Answers(Filter):
    """The levels that the table of segments gave for some sequences."""

    keys: np.ndarray | None = None  # sorted
    found: np.ndarray | None = None

    def levels(self, h: np.ndarray) -> np.ndarray:
        return self.found[np.searchsorted(self.keys, h)]


@dataclass
class Model:
    """The filter, the exact counts of the most frequent words, and the table of the other words."""

    filter: Filter
    head: np.ndarray
    head_counts: np.ndarray
    rest: DataFrame
    table: DataFrame | None = None  # the filter's segments where they are too many for every worker


def learn(docs: DataFrame) -> Model:
    """Count all training texts of ``docs (text)`` and build the filter."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    segments = max(1, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARE))
    built = staged(texts.mapInArrow(_counter(segments), "segment bigint, kind tinyint, h binary, n binary")
                   .groupBy("segment").applyInArrow(_fill, "segment bigint, bits binary, words bigint, total bigint, h binary, n binary"),
                   "segments")
    shape = built.agg(F.sum("words"), F.sum("total"), F.sum(F.octet_length("bits"))).first()
    distinct, total, size = (int(x or 0) for x in shape)
    plain = Filter(None, None, None, segments, total, distinct)
    table = None
    if size <= SENT:
        plain = plain.holding(((r["segment"], r["bits"]) for r in built.select("segment", "bits").toLocalIterator()), 0, segments)
    else:
        table = built.select("segment", "bits")
    words = staged(built.select("h", "n").mapInArrow(_word_rows, "h bigint, n bigint"), "words")
    top = words.orderBy(F.desc("n"), "h").limit(HEAD).toPandas()
    head = top["h"].to_numpy().view(np.uint64)
    order = np.argsort(head)
    return Model(plain, head[order], top["n"].to_numpy()[order].astype(np.float64), words, table)


def _ask_table(rows: DataFrame, model: Model, score, schema: str) -> DataFrame:
    """``score(part, filter)`` of all ``rows (doc_id, digest, text)`` where the filter is a table.

    Documents are dealt to buckets of some megabytes, repeated rows to different ones. A bucket's
    distinct sequences go to the blocks of segments they fall into, one packed binary for each, and the
    levels come back in the same order.
    """
    plain = model.filter
    block = max(1, min(BLOCKS, plain.segments // 256))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET))
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    dealt = numbered.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "digest", "row"), F.lit(buckets))).drop("row")

    def sequences(some: pa.Table) -> np.ndarray:
        """The distinct words and pairs of a bucket, sorted and thus in the order of their segments."""
        found = [np.zeros(0, np.uint64)]
        for part in some.to_batches():
            words = tokens(part.column("text"))
            found.append(np.unique(np.concatenate([words.hashes, pair_hashes(words)])))
        return np.unique(np.concatenate(found))

    def ask(some: pa.Table) -> pa.Table:
        h = sequences(some)
        place = _segment(h, plain.segments) // block
        cuts = _cuts(place)
        return pa.table({"bucket": pa.array(np.full(len(cuts) - 1, some.column("bucket")[0].as_py())),
                         "block": pa.array(place[cuts[:-1]]),
                         "h": pa.array([pack(h[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())})

    def answer(asked: pa.Table, held: pa.Table) -> pa.Table:
        found = []
        if asked.num_rows:
            first = asked.column("block")[0].as_py() * block
            own = ((s.as_py(), b.as_buffer()) for s, b in zip(held.column("segment"), held.column("bits"), strict=True))
            part = plain.holding(own, first, block)
            found = [part.levels(unpack(h.as_py())).astype(np.uint8).tobytes() for h in asked.column("h")]
        return pa.table({"bucket": asked.column("bucket"), "block": asked.column("block"),
                         "level": pa.array(found, pa.binary())})

    def finish(some: pa.Table, told: pa.Table) -> pa.Table:
        pieces = sorted(zip(told.column("block").to_pylist(), told.column("level").to_pylist(), strict=True))
        levels = np.frombuffer(b"".join(level for _, level in pieces), np.uint8).astype(np.int64)
        found = Answers(None, None, None, plain.segments, plain.total, plain.distinct, 0, sequences(some), levels)
        return pa.Table.from_batches([score(part, found) for part in some.to_batches() if part.num_rows])

    asked = dealt.groupBy("bucket").applyInArrow(ask, "bucket bigint, block bigint, h binary")
    filled = model.table.withColumn("block", F.floor(F.col("segment") / block))
    told = asked.groupBy("block").cogroup(filled.groupBy("block")).applyInArrow(
        answer, "bucket bigint, block bigint, level binary")
    return dealt.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(finish, schema)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score)`` for each row of ``docs (doc_id, text, ...)``.

    ``base_score`` sums ``log10((c + 0.1) / (N + 0.1 * (V + 1)))`` over exact counts; ``score`` is the
    filter's log10 probability of the text. A NULL or empty text is one end. All rows stay, repeated
    ones too; other columns are not read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.filter, model.head, model.head_counts))
    below = model.filter.total + 0.1 * (model.filter.distinct + 1)
    rows = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("digest"), F.col("text").cast("string").alias("text"))

    def known(hashes: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(head):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(head, hashes), len(head) - 1)
        return head[at] == hashes, at

    def score(part: pa.RecordBatch, found: Filter) -> pa.RecordBatch:
        _, head, counts = shared.value
        some = tokens(part.column("text"))
        there, at = known(some.hashes, head)
        logs = np.zeros(len(some.hashes))
        logs[there] = np.log10((counts[at[there]] + 0.1) / below)
        begin = some.ends[:-1]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("digest"), pa.array(np.diff(some.ends)),
             pa.array(np.add.reduceat(there.astype(np.int64), begin)), pa.array(np.add.reduceat(logs, begin)),
             pa.array(found.score(some))], names=["doc_id", "digest", "n_tokens", "head_known", "head_score", "score"])

    def score_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield score(part, shared.value[0])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, head, _ = shared.value
        for part in _parts(batches):
            some = tokens(part.column("text"))
            rare = ~known(some.hashes, head)[0]
            row = np.repeat(np.arange(part.num_rows), np.diff(some.ends))[rare]
            h = some.hashes[rare]
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])[:len(row)])
            times = np.diff(np.append(new, len(row)))
            # One more line for each document tells how many rows repeat it.
            take = pa.array(np.concatenate([row[new], np.arange(part.num_rows)]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(take), part.column("digest").take(take),
                 pa.array(np.concatenate([h[new].view(np.int64), np.zeros(part.num_rows, np.int64)])),
                 pa.array(np.concatenate([times, np.zeros(part.num_rows, np.int64)]).astype(np.int32)),
                 pa.array(np.concatenate([np.zeros(len(new)), np.ones(part.num_rows)]).astype(np.int32))],
                names=["doc_id", "digest", "h", "times", "row"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, digest bigint, n_tokens bigint, head_known bigint, head_score double, score double"
    scored = rows.mapInArrow(score_all, schema) if model.table is None else _ask_table(rows, model, score, schema)
    rare = rows.mapInArrow(others, f"doc_id {id_type}, digest bigint, h bigint, times int, row int")
    log = F.log10((F.coalesce("n", F.lit(0)) + 0.1) / below)
    summed = rare.join(model.rest, "h", "left").groupBy("doc_id", "digest").agg(
        F.sum(F.col("times") * log).alias("rare_score"), F.sum("row").alias("rows"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"))
    summed = summed.withColumnsRenamed({"doc_id": "__doc", "digest": "__digest"})
    same = scored["doc_id"].eqNullSafe(summed["__doc"]) & scored["digest"].eqNullSafe(summed["__digest"])
    return scored.join(summed, same).select(
        "doc_id", "n_tokens", (F.col("head_known") + (F.col("rare_known") / F.col("rows")).cast("bigint")).alias("n_known"),
        (F.col("head_score") + F.col("rare_score") / F.col("rows")).alias("base_score"), "score")
