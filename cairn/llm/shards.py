"""Byte-balanced shards by Karmarkar-Karp differencing.

Equal texts are one indivisible group. A partial partition is a tuple of loads, one for each shard;
the two of largest spread are combined, the heavy end of one with the light end of the other, until
one is left. Groups are dealt into chunks of bounded size by hash, each chunk is differenced in a
task of its own, and the chunks' tuples are combined by the same rule in rounds of bounded fan-in.
The few groups large enough to matter alone are differenced first, and every chunk starts from a
scaled copy of their loads, so a text that holds a third of all rows does not upset the balance.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import staged

CHUNK, FAN_IN = 8192, 1024
HEAVY = 256  # a group above 1 / (shards * HEAVY) of all bytes is heavy: shards * HEAVY of them at most


def differencing(tuples: list[list[int]], kinds: list[int] | None = None) -> tuple[list[int], list[list[int]]]:
    """Combine partial partitions until one is left.

    Returns its loads and, for each tuple, the place in them of each of the tuple's own loads.
    ``kinds`` restricts exchanges: a load may only meet loads of its own kind at the same places.
    """
    shards = len(tuples[0])
    if kinds is None:
        groups = [list(range(shards))]
    else:
        groups = [[i for i in range(shards) if kinds[i] == k] for k in sorted(set(kinds))]
    loads = [list(t) for t in tuples]
    merged: list[tuple[int, int, list[int]]] = []
    heap = [(min(t) - max(t), i) for i, t in enumerate(loads)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        x, y = loads[a], loads[b]
        partner = [0] * shards  # for each place of a, the place of b that joins it
        for group in groups:
            up = sorted(group, key=x.__getitem__, reverse=True)
            down = sorted(group, key=y.__getitem__)
            for i, j in zip(up, down, strict=True):
                partner[i] = j
        total = [x[i] + y[partner[i]] for i in range(shards)]
        loads.append(total)
        merged.append((a, b, partner))
        heapq.heappush(heap, (min(total) - max(total), len(loads) - 1))
    places: list[list[int] | None] = [None] * len(loads)
    places[-1] = list(range(shards))
    for node in range(len(loads) - 1, len(tuples) - 1, -1):
        a, b, partner = merged[node - len(tuples)]
        own = places[node]
        places[a] = own
        places[b] = [0] * shards
        for i, j in enumerate(partner):
            places[b][j] = own[i]
    return loads[-1], places[:len(tuples)]


def _singles(sizes: list[int], shards: int) -> list[list[int]]:
    return [[size] + [0] * (shards - 1) for size in sizes]


def _level(loads: list[int], light: int) -> list[int]:
    """What each shard may still take of ``light`` bytes so that all end as even as they can."""
    order, free = sorted(loads), light
    level = order[0]
    for k in range(1, len(order) + 1):
        step = (order[k] - order[k - 1]) * k if k < len(order) else None
        if step is None or step > free:
            level = order[k - 1] + free / k
            break
        free -= step
    return [max(0, round(level - x)) for x in loads]


def shard_documents(docs: DataFrame, shards: int = 16, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``(id, size, text_crc32, shard, slot)`` for each row of ``docs``.

    ``size`` is the text's length in UTF-8 plus one. Equal texts share a shard, a NULL text counts as
    an empty one. Slots count a shard's rows from 0 without gaps. All rows stay, repeated ones too;
    an empty table gives an empty table. Other columns are not read.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = staged(docs.select(
        F.col(id_column).alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("key")), "rows")
    groups = staged(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    whole = groups.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("rows"), F.count("*").alias("groups")).first()
    total, n_rows = whole["bytes"] or 0, whole["rows"] or 0
    is_heavy = F.col("bytes") * (shards * HEAVY) > total
    heavy = sorted((-r["bytes"], bytes(r["key"])) for r in groups.where(is_heavy).collect())
    loads, spots = differencing([[0] * shards, *_singles([-b for b, _ in heavy], shards)])
    fixed = {key: spot[0] for (_, key), spot in zip(heavy, spots[1:], strict=True)}
    light = total - sum(loads)
    room = _level(loads, light)
    top = max(room)
    behind = [top - x for x in room]  # what each shard is ahead by, were all light bytes one chunk
    chunks = max(1, math.ceil((whole["groups"] - len(heavy)) / CHUNK))
    shape = "key binary, chunk bigint, part int, bytes bigint"

    def deal(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values(["bytes", "key"], ascending=[False, True], ignore_index=True)
        share = float(chunk["bytes"].sum()) / max(1, light)
        start = [round(x * share) for x in behind]
        _, at = differencing([start, *_singles(chunk["bytes"].tolist(), shards)])
        # The place that holds the scaled load of shard k is part k.
        part = np.argsort(at[0])
        return pd.DataFrame({"key": chunk["key"], "chunk": chunk["chunk"],
                             "part": [int(part[spot[0]]) for spot in at[1:]], "bytes": chunk["bytes"]})

    parts = staged(groups.where(~is_heavy).withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)))
                   .select("key", "bytes", "chunk").groupBy("chunk").applyInPandas(deal, shape), "parts")
    kinds = behind  # shards equally far ahead may change places between chunks
    tuples = parts.groupBy("chunk", "part").agg(F.sum("bytes").alias("bytes")).select(
        F.col("chunk").alias("node"), "part", "bytes")
    moves = parts.sparkSession.range(0, shards * chunks).select(
        F.floor(F.col("id") / shards).alias("chunk"), F.floor(F.col("id") / shards).alias("node"),
        (F.col("id") % shards).cast("int").alias("part"), (F.col("id") % shards).cast("int").alias("at"))
    left = chunks

    def combine(some: pd.DataFrame) -> pd.DataFrame:
        wide = some.pivot_table(index="node", columns="part", values="bytes", fill_value=0, aggfunc="sum")
        wide = wide.reindex(columns=range(shards), fill_value=0).sort_index()
        sums, at = differencing([[int(v) for v in row] for row in wide.to_numpy()], kinds)
        node = np.repeat(wide.index.to_numpy(), shards)
        spots = np.array(at, dtype=np.int64).ravel()
        return pd.DataFrame({"node": node, "part": np.tile(np.arange(shards), len(wide)), "up": node // FAN_IN,
                             "spot": spots, "bytes": np.array(sums)[spots]})

    while left > 1:
        done = staged(tuples.groupBy(F.floor(F.col("node") / FAN_IN).alias("up")).applyInPandas(
            combine, "node bigint, part int, up bigint, spot int, bytes bigint"), "round")
        moves = staged(moves.join(done.select("node", F.col("part").alias("at"), "up", "spot"), ["node", "at"], "left")
                       .select("chunk", F.coalesce("up", F.floor(F.col("node") / FAN_IN)).alias("node"), "part",
                               F.coalesce("spot", "at").alias("at")), "moves")
        tuples = done.groupBy(F.col("up").alias("node"), F.col("spot").alias("part")).agg(F.max("bytes").alias("bytes"))
        left = math.ceil(left / FAN_IN)
    home = staged(parts.join(moves.select("chunk", "part", F.col("at").alias("shard")), ["chunk", "part"])
                  .select("key", "shard").union(_fixed(groups, is_heavy, fixed)), "home")
    placed = rows.join(home, "key")
    buckets = max(1, math.ceil(n_rows / (shards * 2048)))
    placed = staged(placed.select("doc_id", "size", "text_crc32", "shard", F.pmod(
        F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)).alias("bucket")), "placed")
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    offsets = staged(counts.select("shard", "bucket", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before")), "offsets")
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    return (placed.withColumn("inside", inside).join(offsets, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("before") + F.col("inside") - 1).cast("bigint").alias("slot")))


def _fixed(groups: DataFrame, is_heavy, fixed: dict[bytes, int]) -> DataFrame:
    """The shards of the heavy groups as rows."""
    if not fixed:
        return groups.where("false").select("key", F.lit(0).alias("shard"))
    pairs = F.create_map(*(F.lit(x) for key, shard in fixed.items() for x in (key.hex().upper(), shard)))
    return groups.where(is_heavy).select("key", F.element_at(pairs, F.hex("key")).alias("shard"))
