"""Prefix trie of rebuilt conversations, without rebuilding their texts.

A rebuilt conversation is the head of one stored conversation followed by the tail of another. A
sequence of turns has a fingerprint in a monoid: its length ``n`` and the sum ``G`` of ``t(i) * B**i``
modulo a prime, with ``(n, G) * (m, H) = (n + m, G + B**n * H)``. Fingerprints of stored prefixes are
running sums, a tail's is the quotient of two of them, and that of every rebuilt prefix follows from
head and tail by the product. Four primes make 124 bits. Rebuilt rows carry fingerprints and a
reference to their last turn's content, never a text.

Equality is verified. Contents are referred to by 128 bits that a pass over all distinct contents shows
to be free of collisions, and all members of a node must agree in parent and in last content; by
induction they are then the same turns. Where that fails, everything is done again with other bases.

A node belongs to its smallest member, so a conversation owns one path of the trie, from where it
leaves smaller conversations to its end. Sums over subtrees are sums over paths, found by pointer
doubling in as many rounds as the logarithm of the paths' nesting, and running sums along paths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.scan import lay_out, running_sums
from cairn.session import staged

#: The four largest primes below 2**31; products of two residues fit a long.
PRIMES = [2147483647, 2147483629, 2147483587, 2147483579]
NOTHING = hashlib.sha256(b"").hexdigest()


def _bases(salt: int) -> list[int]:
    """A base for each prime, by its own hash."""
    return [int.from_bytes(hashlib.sha256(f"{salt}/{p}".encode()).digest()[:8], "big") % (p - 2) + 2 for p in PRIMES]


def _power(base: int, prime: int, exponent: Column) -> Column:
    """``base ** exponent`` modulo the prime: one product for each bit that the exponent has."""
    squares = [pow(base, 1 << k, prime) for k in range(40)]
    bits = F.sequence(F.lit(0), F.length(F.bin(exponent)) - 1)

    def step(total: Column, k: Column) -> Column:
        odd = F.getbit(exponent, k) == 1
        return F.when(odd, total * F.element_at(F.lit(squares).cast("array<bigint>"), k + 1) % prime).otherwise(total)

    return F.aggregate(bits, F.lit(1).cast("bigint"), step)


def _terms(salt: int, place: Column) -> list[Column]:
    """What a turn at a place (from 1) adds to the four fingerprints."""
    content = [F.col("c1"), F.col("c1"), F.col("c2"), F.col("c2")]
    return [F.pmod(c, F.lit(p)) * _power(b, p, place) % p for c, p, b in zip(content, PRIMES, _bases(salt), strict=True)]


def _packed(parts: list[Column]) -> list[Column]:
    """Four residues as two longs."""
    return [F.shiftleft(parts[k], 31).bitwiseOR(parts[k + 1]) for k in (0, 2)]


def turn_references(turns: DataFrame) -> DataFrame:
    """``(conv, turn, c1, c2, bytes)``: a row for each turn, with a reference to its content."""
    worded = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for salt in count():
        held = worded.withColumns({"c1": F.xxhash64(F.lit(salt), "role", "text"),
                                   "c2": F.xxhash64(F.lit(salt), F.lit("second"), "text", "role")})
        contents = held.select("c1", "c2", "role", "text").distinct()
        if contents.groupBy("c1", "c2").count().where("count > 1").isEmpty():
            return held.select("conv", "turn", "c1", "c2", F.octet_length("text").cast("bigint").alias("bytes"))
    raise AssertionError


def stored_prefixes(laid: DataFrame, salt: int) -> DataFrame:
    """``(conv, pos, c1, c2, bytes, g0, g1, g2, g3)``: the fingerprint of each stored prefix; ``pos`` from 1."""
    order = ["turn", "c1", "c2"]
    placed = staged(running_sums(laid, "conv", order, {"pos": F.lit(1).cast("bigint")}), "places")
    terms = staged(placed.withColumns({f"t{k}": t for k, t in enumerate(_terms(salt, F.col("pos")))}), "terms")
    summed = running_sums(terms, "conv", order, {f"g{k}": F.col(f"t{k}") for k in range(len(PRIMES))})
    return staged(summed.select("conv", "pos", "c1", "c2", "bytes",
                                *((F.col(f"g{k}") % p).alias(f"g{k}") for k, p in enumerate(PRIMES))), "prefixes")


def rebuild_plan(prefixes: DataFrame, base: Column, head: Column) -> DataFrame:
    """``(conv, base, h, own, shared)``: the head comes from ``base``, at most ``h`` and really ``shared`` turns.

    ``base`` and ``head`` are columns of ``conv``; ``own`` is the number of stored turns.
    """
    sizes = staged(prefixes.groupBy("conv").agg(F.count("*").alias("own")), "sizes")
    asked = sizes.select("conv", "own", base.cast("bigint").alias("base"), head.cast("bigint").alias("h"))
    held = sizes.select(F.col("conv").alias("base"), F.col("own").alias("there"))
    return staged(asked.join(held, "base", "left").withColumn("shared", F.least("h", F.coalesce("there", F.lit(0).cast("bigint"))))
                  .select("conv", "base", "h", "own", "shared"), "plan")


def rebuilt_prefixes(prefixes: DataFrame, plan: DataFrame, salt: int) -> DataFrame:
    """``(conv, depth, fa, fb, pa, pb, c1, c2, bytes)``: every prefix of every rebuilt conversation.

    ``f`` is its fingerprint, ``p`` that of the prefix a turn shorter. The empty prefix is depth 0.
    """
    g = [f"g{k}" for k in range(len(PRIMES))]
    zero = F.lit(0).cast("bigint")
    heads = prefixes.withColumnRenamed("conv", "base").join(plan.select("conv", "base", "shared"), "base").where(
        "pos <= shared").select("conv", F.col("pos").alias("depth"), "c1", "c2", "bytes", *g)
    # The product of the head and what is left of the own prefix when its first h turns are divided out.
    ends = prefixes.select(F.col("conv").alias("base"), F.col("pos").alias("shared"), *(F.col(c).alias(f"head_{c}") for c in g))
    cuts = prefixes.select("conv", F.col("pos").alias("h"), *(F.col(c).alias(f"cut_{c}") for c in g))
    joints = plan.where("own > h").join(ends, ["base", "shared"], "left").join(cuts, ["conv", "h"], "left").select(
        "conv", "h", "shared", *(F.coalesce(F.col(f"{side}_{c}"), zero).alias(f"{side}_{c}") for side in ("head", "cut") for c in g))
    tails = prefixes.join(joints, "conv").where("pos > h")

    def product(k: int, p: int, b: int) -> Column:
        # B to the power shared - h, which is not positive.
        back = _power(pow(b, -1, p), p, F.col("h") - F.col("shared"))
        return ((F.col(f"head_g{k}") + F.pmod(F.col(f"g{k}") - F.col(f"cut_g{k}"), F.lit(p)) * back) % p).alias(f"g{k}")

    tails = tails.select("conv", (F.col("pos") - F.col("h") + F.col("shared")).alias("depth"), "c1", "c2", "bytes",
                         *(product(k, p, b) for k, (p, b) in enumerate(zip(PRIMES, _bases(salt), strict=True))))
    before = [F.pmod(F.col(f"g{k}") - t, F.lit(p)) for k, (p, t) in enumerate(zip(PRIMES, _terms(salt, F.col("depth")), strict=True))]
    f, p = _packed([F.col(c) for c in g]), _packed(before)
    below = heads.union(tails).select("conv", "depth", f[0].alias("fa"), f[1].alias("fb"), p[0].alias("pa"), p[1].alias("pb"),
                                      "c1", "c2", "bytes")
    tops = plan.select("conv", *(zero.alias(c) for c in ("depth", "fa", "fb", "pa", "pb", "c1", "c2", "bytes")))
    return tops.union(below)


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined ids of neighbouring rows of one node, a piece for each batch at most."""
    for batch in batches:
        depth, fa, fb, conv = (np.asarray(batch.column(k)) for k in range(4))
        if not len(conv):
            continue
        new = np.flatnonzero((np.diff(depth) != 0) | (np.diff(fa) != 0) | (np.diff(fb) != 0)) + 1
        begin = np.concatenate([[0], new])
        ends = np.append(new, len(conv))
        pieces = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(begin, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x[begin]) for x in (depth, fa, fb, conv)] + [pa.array(pieces, pa.string())],
                                         names=["depth", "fa", "fb", "first", "piece"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes the pieces of every node in their order; no node's pieces are held together."""
    now, state, out = None, None, []
    for batch in batches:
        for depth, fa, fb, piece in zip(*(batch.column(c).to_pylist() for c in ("depth", "fa", "fb", "piece")), strict=True):
            if (depth, fa, fb) != now:
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = (depth, fa, fb), hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if len(out) >= 1000:
            yield _digest_rows(out)
            out = []
    if now is not None:
        out.append((*now, state.hexdigest()))
    yield _digest_rows(out)


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                                      names=["depth", "fa", "fb", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """``(depth, fa, fb, ends_sha256)`` from ``(depth, fa, fb, conv)``, ids ascending.

    Ids are sorted and written out in ranges, so a node where a third of all conversations end is many
    tasks' work; only the digest itself, which no two tasks can share, runs over such a node's pieces in
    one task, piece by piece.
    """
    key = ["depth", "fa", "fb"]
    sorted_ = ends.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")
    pieces = sorted_.mapInArrow(_digest_pieces, "depth bigint, fa bigint, fb bigint, first bigint, piece string")
    return pieces.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(
        _digests, "depth bigint, fa bigint, fb bigint, ends_sha256 string")


def path_sums(paths: DataFrame, values: list[str]) -> DataFrame:
    """Sums of ``values`` over everything below and with each path of ``paths (path, up, ...)``.

    Pointer doubling: after k rounds a path holds the sums of those less than 2**k steps below it and
    points 2**k steps up, so the rounds are the logarithm of the nesting.
    """
    now = paths
    while not now.where("up IS NOT NULL").isEmpty():
        given = now.where("up IS NOT NULL").groupBy(F.col("up").alias("path")).agg(
            *(F.sum(v).alias(f"more_{v}") for v in values))
        over = now.select(F.col("path").alias("up"), F.col("up").alias("next"))
        now = staged(now.join(given, "path", "left").join(over, "up", "left").select(
            "path", F.col("next").alias("up"), *((F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values)), "paths")
    return now.select("path", *values)


def prefix_trie(turns: DataFrame, base: Column, head: Column) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations.

    ``turns (conv_id, turn, role, text)``; ``base`` and ``head`` are columns of ``conv``, the id: the
    first ``head`` stored turns of conversation ``base`` (all if there are fewer, none if there is no
    such conversation) come first, then ``conv``'s own turns after its first ``head``. Returns
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    A NULL role or text is empty, a NULL turn comes first, rows without an id are in no conversation.
    Every row is a turn, repeated rows too; turns of one number go in the order of their content's hash.
    Without turns there is no node. Other columns are not read, whatever their names.
    """
    laid = lay_out(turn_references(turns), "conv", ["turn", "c1", "c2"])
    for salt in count():
        prefixes = stored_prefixes(laid, salt)
        plan = rebuild_plan(prefixes, base, head)
        rows = staged(rebuilt_prefixes(prefixes, plan, salt), "rebuilt")
        same = ["pa", "pb", "c1", "c2"]
        nodes = staged(rows.groupBy("depth", "fa", "fb").agg(
            F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"),
            *(F.min(c).alias(c) for c in same), *(F.max(c).alias(f"most_{c}") for c in same)), "nodes")
        if nodes.where(" OR ".join(f"{c} <> most_{c}" for c in same)).isEmpty():
            break
    over = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fa").alias("pa"), F.col("fb").alias("pb"),
                        F.col("conv_id").alias("parent_conv_id"))
    lengths = plan.select("conv", (F.col("shared") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("depth"))
    ends = end_digests(rows.join(lengths, ["conv", "depth"]).select("depth", "fa", "fb", "conv"))
    tree = staged(nodes.join(over, ["depth", "pa", "pb"], "left").join(ends, ["depth", "fa", "fb"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")), "tree")

    children = tree.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    known = staged(tree.join(children, ["conv_id", "depth"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))), "known")
    tops = known.where("parent_conv_id IS NULL OR parent_conv_id <> conv_id").select(
        F.col("conv_id").alias("path"), F.col("parent_conv_id").alias("up"), (F.col("depth") - 1).alias("at"))
    own = known.groupBy(F.col("conv_id").alias("path")).agg(
        F.sum("saved").alias("saved"), F.sum((F.col("n_children") == 0).cast("bigint")).alias("leaves"))
    paths = staged(tops.join(own, "path"), "paths")
    whole = path_sums(paths.select("path", "up", "saved", "leaves"), ["saved", "leaves"])
    attached = paths.select("path", "up", "at").join(whole, "path").where("up IS NOT NULL").groupBy(
        F.col("up").alias("conv_id"), F.col("at").alias("depth")).agg(
        F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
    zero = F.lit(0).cast("bigint")
    each = known.join(attached, ["conv_id", "depth"], "left").select(
        *known.columns, (-F.col("depth")).alias("rise"), (F.col("saved") + F.coalesce("more_saved", zero)).alias("here"),
        ((F.col("n_children") == 0).cast("bigint") + F.coalesce("more_leaves", zero)).alias("ends"))
    summed = running_sums(lay_out(each, "conv_id", ["rise"]), "conv_id", ["rise"],
                          {"saved_tokens": F.col("here"), "n_leaves": F.col("ends")})
    return summed.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
