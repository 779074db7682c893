"""Near-duplicate documents by HyperMinHash.

A register holds, for one bucket of the hash range, the leading zeros of the smallest hash and the
bits after its first one: sixteen bits in place of sixty-four. Sets large enough to fill them share
32 buckets under each of nine seeds; small sets give each of the 288 registers a seed of its own.
Six registers make a band. Documents that share a band are candidates; the share of equal
registers, less the equalities that chance alone gives, estimates their Jaccard similarity, and
links are confirmed on the full sets of five-word shingles.

Equal sets are one node from the start. A band's bucket links to one of its members first, drawn by
lot so that a document meets many. Only buckets that still hold several components then get the pairs
between those components that their rarest shingles leave possible, so a group of copies costs links
in its size and not in its square, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm import words as w
from cairn.llm.components import components
from cairn.session import staged

SEEDS, BUCKETS, REGISTERS, BAND = 9, 32, 288, 6
SMALL, SHARED = 128, 96  # sets below SMALL use one seed a register; from SHARED on, buckets too
MANTISSA = 10
PERCENT = 75
MARGIN = 0.19  # over six standard errors of the estimate below the threshold
_EMPTY = np.uint16(0xFFFF)
_SEEDS = w.mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SKETCH = ("doc_id bigint, n_shingles bigint, low bigint, high bigint, few binary, many binary")


def _registers(least: np.ndarray) -> np.ndarray:
    """Sixteen bits of each minimum: its leading zeros, then the bits below its first one."""
    least = least | np.uint64(1)
    zeros = (64 - np.frexp(least.astype(np.float64))[1]).clip(0, 62).astype(np.uint64)
    after = (least << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | after).astype(np.uint16)


def sketch_few(hashes: np.ndarray) -> np.ndarray:
    """A register per seed, each over the whole set."""
    return _registers((hashes[None, :] * _SEEDS[:, None]).min(axis=1))


def sketch_many(hashes: np.ndarray) -> np.ndarray:
    """A register per seed and bucket; a bucket without a hash is marked as empty."""
    seeded = np.sort(hashes[None, :] * _SEEDS[:SEEDS, None], axis=1)
    bucket = (seeded >> np.uint64(59)).astype(np.int64)
    first = np.ones(bucket.shape, bool)
    first[:, 1:] = bucket[:, 1:] != bucket[:, :-1]
    row, column = np.nonzero(first)
    out = np.full((SEEDS, BUCKETS), _EMPTY)
    out[row, bucket[row, column]] = _registers(seeded[row, column] << np.uint64(5))
    return out.ravel()


def shingle_sets(text: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    runs = w.shingle_hashes(w.word_hashes(text))
    return (np.unique(runs.of(k)) for k in range(len(text)))


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            rows = []
            for hashes in shingle_sets(part.column("text")):
                n = len(hashes)
                low, high = (int(w.mix(hashes * k).sum(dtype=np.uint64).astype(np.int64)) for k in _SEEDS[:2])
                rows.append((n, low, high,
                             sketch_few(hashes).tobytes() if 0 < n < SMALL else None,
                             sketch_many(hashes).tobytes() if n >= SHARED else None))
            n, low, high, few, many = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(high, pa.int64()), pa.array(few, pa.binary()), pa.array(many, pa.binary())],
                names=["doc_id", "n_shingles", "low", "high", "few", "many"])


def sketches(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, low, high, few, many)``: set size, identity of the set, registers."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_sketch_batches, _SKETCH)


def bands(sets: DataFrame) -> DataFrame:
    """``(key, id)``: one row for each band of each sketch."""
    parts = []
    for kind, name in enumerate(("few", "many")):
        some = sets.where(F.col(name).isNotNull())
        rows = some.select("id", name, F.explode(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1))).alias("b"))
        parts.append(rows.select(F.xxhash64(
            F.lit(kind), "b", F.substring(F.col(name), F.col("b") * (2 * BAND) + 1, F.lit(2 * BAND))
        ).alias("key"), "id"))
    return parts[0].union(parts[1])


def similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, kept: int) -> np.ndarray:
    """Estimated Jaccard similarity of rows of registers, less the expected chance equalities.

    For two sets of sizes n and m, two unrelated registers agree with a chance near
    ``0.1699 * 2**(1 - bits) * 4nm / (n + m)**2``; ``kept`` is the number of mantissa bits.
    """
    used = (a != _EMPTY) | (b != _EMPTY)
    share = ((a == b) & used).sum(axis=1) / np.maximum(used.sum(axis=1), 1)
    chance = 0.16992 * 2.0 ** (1 - kept) * 4 * n_a * n_b / np.maximum(n_a + n_b, 1) ** 2
    return (share - chance) / (1 - chance)


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _estimate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = _stack(batch.column("a")), _stack(batch.column("b"))
        n_a, n_b = (batch.column(c).to_numpy().astype(np.float64) for c in ("n_u", "n_v"))
        near = similarity(a, b, n_a, n_b, MANTISSA) >= PERCENT / 100 - MARGIN
        yield batch.filter(pa.array(near)).select(["u", "v"])


def _confirm_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = []
        for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
            both = len(np.intersect1d(x, y, assume_unique=True))
            near.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.filter(pa.array(near, pa.bool_())).select(["u", "v"])


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = [s.tobytes() for s in shingle_sets(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.binary())], names=["id", "shingles"])


def _confirmed(pairs: DataFrame, sets: DataFrame, full: DataFrame) -> DataFrame:
    """Of candidate pairs ``(u, v)`` those that the estimate lets pass and the full sets confirm."""
    side = sets.select("id", F.col("n_shingles").alias("n"), "few", "many")
    left = side.select(F.col("id").alias("u"), F.col("n").alias("n_u"), F.col("few").alias("few_u"),
                       F.col("many").alias("many_u"))
    right = side.select(F.col("id").alias("v"), F.col("n").alias("n_v"), F.col("few").alias("few_v"),
                        F.col("many").alias("many_v"))
    sized = (F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * PERCENT)
    shared = F.col("many_u").isNotNull() & F.col("many_v").isNotNull()
    rows = (pairs.join(left, "u").join(right, "v").where(sized)
            .select("u", "v", "n_u", "n_v", F.when(shared, F.col("many_u")).otherwise(F.col("few_u")).alias("a"),
                    F.when(shared, F.col("many_v")).otherwise(F.col("few_v")).alias("b")))
    near = rows.where("a IS NOT NULL AND b IS NOT NULL").mapInArrow(_estimate_batches, "u bigint, v bigint")
    a = full.select(F.col("id").alias("u"), F.col("shingles").alias("a"))
    b = full.select(F.col("id").alias("v"), F.col("shingles").alias("b"))
    return near.join(a, "u").join(b, "v").mapInArrow(_confirm_batches, "u bigint, v bigint")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _labelled(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Add ``label_<column>``: the component of a node, or the node itself."""
    named = labels.select(F.col("node").alias(column), F.col("label").alias("__label"))
    return rows.join(named, column, "left").withColumn(
        f"label_{column}", F.coalesce("__label", column)).drop("__label")


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            sets = [np.frombuffer(s.as_buffer(), np.int64) for s in part.column("shingles")]
            rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(rows)), pa.array(np.concatenate(sets))], names=["id", "h"])


def _pairs_between(crowded: DataFrame, sets: DataFrame, full: DataFrame) -> DataFrame:
    """Pairs ``(u, v)`` of different components that could be linked, of documents in mixed buckets.

    Two sets of sizes n and m that are linked have 3/7 of n + m in common at least. With every set
    ordered from its rarest shingle to its most frequent one, two linked sets meet in an early
    place: where their first common shingle stands, enough must still follow in both. What a whole
    group has in common comes last and brings nobody together.
    """
    kinds = crowded.groupBy("key").agg(F.min("label_id").alias("a"), F.max("label_id").alias("b")).where("a < b")
    mixed = staged(crowded.join(kinds.select("key"), "key").select("id", F.col("label_id").alias("label")).distinct(), "mixed")
    hashes = staged(full.join(mixed.select("id"), "id").mapInArrow(_hash_batches, "id bigint, h bigint").distinct(), "hashes")
    often = staged(hashes.groupBy("h").agg(F.count("*").alias("df")), "often")
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "h"))
    size = sets.select("id", F.col("n_shingles").alias("n")).distinct()
    placed = (hashes.join(often, "h").withColumn("place", place).where("df > 1")
              .join(staged(mixed.join(size, "id"), "sized"), "id"))
    need, base = PERCENT, 100 + PERCENT  # in common at least: need / base of both sizes

    def possible(left, n, other):
        return base * left >= need * (n + other)

    left = F.col("n") - F.col("place") + 1
    early = staged(placed.withColumn("left", left).where(
        possible(left, F.col("n"), F.ceil(F.col("n") * PERCENT / 100))), "early")
    least = early.groupBy("h").agg(F.min("n").alias("least"), F.min("label").alias("a"), F.max("label").alias("b"))
    rows = staged(early.join(staged(least.where("a < b").select("h", "least"), "least"), "h")
                  .where(possible(F.col("left"), F.col("n"), F.col("least"))).drop("least", "df", "place"), "rows")
    # What the best of a component's rows could reach decides whether its rows are looked at.
    named = rows.groupBy("h", "label").agg(F.max("left").alias("most"), F.min("n").alias("size"))
    one, two = (named.select("h", *(F.col(c).alias(f"{c}_{x}") for c in ("label", "most", "size"))) for x in "uv")
    meet = one.join(two, "h").where((F.col("label_u") < F.col("label_v")) & possible(
        F.least("most_u", "most_v"), F.col("size_u"), F.col("size_v"))).drop("most_u", "size_u")

    def side(x: str) -> DataFrame:
        return rows.select("h", *(F.col(c).alias(f"{c}_{x}") for c in ("label", "n", "left")), F.col("id").alias(x))

    half = meet.join(side("u"), ["h", "label_u"]).where(possible(
        F.least("left_u", "most_v"), F.col("n_u"), F.col("size_v")))
    both = half.join(side("v"), ["h", "label_v"])
    return both.where(possible(F.least("left_u", "left_v"), F.col("n_u"), F.col("n_v"))
                      & (100 * F.least("n_u", "n_v") >= PERCENT * F.greatest("n_u", "n_v")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs (doc_id, text, ...)``.

    Documents are linked where 100 * intersection >= 75 * union of their shingle sets. A NULL or
    empty text has no shingles and is linked with nothing; fewer than five words are one shingle. A
    row without an id is linked with nothing, has no component and is kept. Rows that repeat an id
    share a component through it. Columns besides ``doc_id`` and ``text`` are not read.
    """
    every = staged(sketches(docs), "sketches")
    useful = every.where("doc_id IS NOT NULL AND n_shingles > 0")
    same = ["n_shingles", "low", "high"]
    nodes = staged(useful.groupBy(*same).agg(F.min("doc_id").alias("id")), "nodes")
    joined = useful.join(nodes, same)
    sets = staged(joined.where("doc_id = id").select("id", "n_shingles", "few", "many"), "sets")
    member = joined.select("doc_id", "id").distinct()

    # Each bucket of two sets or more gets one member by lot as its hub.
    keys = bands(sets).withColumn("lot", F.xxhash64("id", "key"))
    buckets = staged(keys.groupBy("key").agg(F.min("lot").alias("least"), F.max("lot").alias("most"))
                     .where("least < most").select("key", "least"), "buckets")
    crowded = staged(keys.join(buckets, "key").select("key", "id", (F.col("lot") == F.col("least")).alias("hub")), "crowded")
    asked = crowded.select("id").distinct()
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    full = staged(texts.join(staged(asked, "asked"), "id").mapInArrow(_set_batches, "id bigint, shingles binary"), "shingles")

    # First every document with the hubs of its buckets.
    hubs = crowded.where("hub").select("key", F.col("id").alias("v"))
    stars = _ordered(crowded.where("NOT hub").select("key", F.col("id").alias("u")).join(hubs, "key"))
    labels = staged(components(_confirmed(stars, sets, full)), "labels")
    # Then all pairs between components of one bucket that can be similar at all.
    rest = _ordered(_pairs_between(_labelled(crowded, labels, "id"), sets, full))
    more = staged(_confirmed(rest, sets, full), "links")
    if not more.isEmpty():
        # Links between components join them; the nodes follow their component.
        joins = _labelled(_labelled(more, labels, "u"), labels, "v").select(
            F.col("label_u").alias("u"), F.col("label_v").alias("v"))
        wider = staged(components(joins), "wider")
        nodes_of = labels.union(wider.select("node", F.col("node").alias("label"))).distinct()
        labels = staged(_labelled(nodes_of, wider, "label").select(
            "node", F.col("label_label").alias("label")).groupBy("node").agg(F.min("label").alias("label")), "labels")
    found = member.join(labels, member["id"] == labels["node"], "left").select(
        "doc_id", F.coalesce("label", "id").alias("component_id"))
    # A repeated id with several texts belongs to the smallest of its components.
    found = staged(found.groupBy("doc_id").agg(F.min("component_id").alias("component_id")), "found")
    return (every.select("doc_id", "n_shingles").join(found, "doc_id", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
