"""Runs: stretches of words that repeat with a period, found by internal pattern matching.

A run of period ``q`` that is ``max(12, 2q)`` words long has a stretch of ``max(12 - q, q)`` words that
occurs again ``q`` words later, and such a stretch contains a dyadic block: a block of ``m = 2**k`` words
that begins at a multiple of a stride. Every block asks for its occurrences in the neighbouring
window, where its level's periods point. The suffix array gives the interval of suffixes that begin
with the block, and a wavelet tree over it answers by rank and range successor how many of them lie in
the window, and the first, second and last. Windows are short enough that occurrences form one
progression: one or two occurrences are candidate periods; more are a progression whose difference is
the block's own period. Where block and progression lie in one run of that period, the difference
is the candidate, else all members are, each tested by longest common extensions to both sides.

Documents are independent, so nothing is shuffled. A batch is worked on in pieces of about
``PIECE`` words and whole documents, all documents of a piece at once in numpy. Documents in which no
four words occur twice hold no run and are left out before suffixes are sorted.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.words import mix

#: Shortest run in words, and words worked on at once.
LEAST, PIECE = 12, 1 << 18
#: Block length, stride and periods of the two lowest levels; level k > 2 has length and stride 2**k
#: and periods 2**(k + 1) - 1 to 2**(k + 2) - 2.
LOWEST = [(2, 3, 1, 6), (2, 4, 7, 14)]


class Wavelet:
    """A wavelet tree, kept level by level, over whole numbers: counts and order statistics of any interval."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        now = values
        for level in range(self.bits - 1, -1, -1):
            bit = (now >> level) & 1
            count = np.zeros(len(now) + 1, np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(now) - int(count[-1]))
            high = bit.astype(bool)
            now = np.concatenate([now[~high], now[high]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values at places ``low`` to ``high`` are less than the bound."""
        total = np.where(bound >> self.bits > 0, high - low, 0)
        inside = bound >> self.bits == 0
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = ((bound >> (self.bits - 1 - k)) & 1).astype(bool)
            a, b = ones[low], ones[high]
            total += np.where(inside & bit, (high - low) - (b - a), 0)
            low, high = np.where(bit, zeros + a, low - a), np.where(bit, zeros + b, high - b)
        return total

    def smallest(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of a rank, from 0, among those at places ``low`` to ``high``."""
        found = np.zeros(len(low), np.int64)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            a, b = ones[low], ones[high]
            less = (high - low) - (b - a)
            up = rank >= less
            rank = np.where(up, rank - less, rank)
            found |= up.astype(np.int64) << (self.bits - 1 - k)
            low, high = np.where(up, zeros + a, low - a), np.where(up, zeros + b, high - b)
        return found


class Factors:
    """Ranks of all blocks of 1, 2, 4, ... words; equal within a level only for equal blocks of one text.

    ``text[i]`` is the number of the text that word ``i`` belongs to and ``stop[i]`` where it ends. The
    last ranks order the suffixes; from level 2 on only places whose four words occur twice are ordered.
    """

    def __init__(self, words: np.ndarray, text: np.ndarray, stop: np.ndarray):
        n = len(words)
        self.n = n
        longest = int((stop - np.arange(n)).max(initial=1))
        keys = mix(words.view(np.uint64) + mix(text.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(keys, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = _starts(keys[order])
        self.ranks = [rank]
        place = np.arange(n)
        for k in (0, 1):
            both = rank * (n + 1) + _after(rank, place, stop, 1 << k) + 1
            order = np.argsort(both, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = _starts(both[order])
            rank = new
            self.ranks.append(rank)
        # From here on a rank is a place among the suffixes whose first four words occur twice.
        size = np.bincount(rank, minlength=n)
        twice = size[rank[order]] > 1
        self.suffixes = order[twice]
        m = len(self.suffixes)
        lead = _starts(rank[self.suffixes])
        rank = n + place
        rank[self.suffixes] = lead
        self.ranks[2] = rank
        open_ = np.arange(m)  # places in the suffix array whose order is not settled
        open_ = open_[_shared(lead)]
        for k in range(2, max(2, longest.bit_length())):
            if len(open_):
                who = self.suffixes[open_]
                first, second = rank[who], _after(rank, who, stop, 1 << k)
                turn = np.lexsort((second, first))
                who, first, second = who[turn], first[turn], second[turn]
                self.suffixes[open_] = who
                new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
                lead = open_[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
                rank = rank.copy()
                rank[who] = lead
                open_ = open_[_shared(lead)]
            self.ranks.append(rank)

    def sizes(self, level: int) -> np.ndarray:
        """How many suffixes share each rank of a level from 2 on."""
        return np.bincount(self.ranks[level][self.suffixes], minlength=len(self.suffixes))

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are equal from ``i`` and from ``j`` on; ``i`` before ``j``, in one text."""
        length = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, a, b = self.ranks[k], i + length, j + length
            ok = b < self.n
            same = np.zeros(len(i), bool)
            same[ok] = rank[a[ok]] == rank[b[ok]]
            length += same.astype(np.int64) << k
        return length

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are equal up to and without ``i`` and ``j``."""
        length = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, a, b = self.ranks[k], i - length - (1 << k), j - length - (1 << k)
            ok = a >= 0
            same = np.zeros(len(i), bool)
            same[ok] = rank[a[ok]] == rank[b[ok]]
            length += same.astype(np.int64) << k
        return length


def _starts(ordered: np.ndarray) -> np.ndarray:
    """For each place of an ordered array the first place with its value."""
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(ordered)]
    return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))


def _shared(lead: np.ndarray) -> np.ndarray:
    same = np.zeros(len(lead) + 1, bool)
    same[1:-1] = lead[1:] == lead[:-1]
    return same[1:] | same[:-1]


def _after(rank: np.ndarray, place: np.ndarray, stop: np.ndarray, step: int) -> np.ndarray:
    """The rank ``step`` words later, -1 past the text's end."""
    later = place + step
    inside = later < stop[place]
    out = np.full(len(place), -1, np.int64)
    out[inside] = rank[later[inside]]
    return out


def _levels(longest: int) -> Iterator[tuple[int, int, int, int]]:
    yield from LOWEST
    k = 3
    while 2 * ((2 << k) - 1) <= longest:
        yield k, 1 << k, (2 << k) - 1, (4 << k) - 2
        k += 1


def find_runs(words: np.ndarray, text: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """``(start, end, period)`` of all runs, by start and period; words are numbers, texts lie end to end.

    ``text`` numbers each word's text and ``stop`` tells where it ends.
    """
    none = np.zeros((0, 3), np.int64)
    if len(words) < LEAST:
        return none
    factors = Factors(words, text, stop)
    if not len(factors.suffixes):
        return none
    tree = Wavelet(factors.suffixes)
    found = []
    for k, stride, least, most in _levels(int((stop - np.arange(len(words))).max())):
        size, rank = factors.sizes(k), factors.ranks[k]
        block = np.arange(0, len(words), stride)
        block = block[rank[block] < len(size)]
        block = block[size[rank[block]] > 1]
        width = min(1 << k, most - least + 1)
        for low in range(least, most + 1, width):
            high = min(low + width - 1, most)
            found.append(_window(factors, tree, block, rank[block], size, low, high))
    pairs = np.concatenate(found)
    pairs = pairs[pairs[:, 1] > 0]
    if not len(pairs):
        return none
    at, period = pairs[:, 0], pairs[:, 1]
    begin = at - factors.behind(at, at + period)
    end = at + period + factors.ahead(at, at + period)
    long = end - begin >= np.maximum(LEAST, 2 * period)
    runs = np.unique(np.stack([begin[long], end[long], period[long]], axis=1), axis=0)
    # One stretch has one run, that of its smallest period; the others are multiples.
    return runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)])] if len(runs) else none


def _window(factors: Factors, tree: Wavelet, block: np.ndarray, rank: np.ndarray, size: np.ndarray,
            low: int, high: int) -> np.ndarray:
    """Blocks and candidate periods, from the blocks' occurrences ``low`` to ``high`` words later."""
    left, right = rank, rank + size[rank]
    before = tree.below(left, right, block + low)
    held = tree.below(left, right, block + high + 1) - before
    some = held > 0
    block, left, right, before, held = (x[some] for x in (block, left, right, before, held))
    first = tree.smallest(left, right, before)
    out = [np.stack([block, first - block], axis=1)]
    several = held > 1
    block, left, right, before, held, first = (x[several] for x in (block, left, right, before, held, first))
    second = tree.smallest(left, right, before + 1)
    two = held == 2
    out.append(np.stack([block[two], (second - block)[two]], axis=1))
    block, first, step, held = (x[~two] for x in (block, first, second - first, held))
    if len(block):
        # The stretch of the block's own period around the block and around its progression.
        same = factors.behind(block, block + step), factors.behind(first, first + step)
        one = block - same[0] == first - same[1]
        out.append(np.stack([block[one], step[one]], axis=1))
        block, first, step, held = (x[~one] for x in (block, first, step, held))
        nth = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
        out.append(np.stack([np.repeat(block, held), np.repeat(first - block, held) + nth * np.repeat(step, held)], axis=1))
    return np.concatenate(out)


def repeats_four(words: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Which texts have four neighbouring words that occur twice; others have no run."""
    out = np.zeros(n_texts, bool)
    if len(words) < 4:
        return out
    key = mix(text[:-3].astype(np.uint64) + np.uint64(1))
    for j in range(4):
        key = mix(key + words[j:len(words) - 3 + j].view(np.uint64))
    inner = np.flatnonzero(text[:-3] == text[3:])
    key, owner = key[inner], text[inner]
    order = np.argsort(key)
    again = order[1:][key[order[1:]] == key[order[:-1]]]
    out[owner[again]] = True
    return out


def looped(words: list[bytes], doc_id: int) -> list[bytes]:
    """A tenth of the documents, by their id's checksum, end in a loop of words that the id chooses."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    loop = words[a:a + p]
    return words[:a] + (loop * ((n - a) // p + 1))[:n - a]


def _result(words: list[bytes], runs: np.ndarray) -> tuple:
    """``(n_runs, start, length, period, runs_sha256, collapsed_sha256)`` of one text."""
    if not len(runs):
        return 0, None, None, None, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()
    listed = sorted((s, e - s, q) for s, e, q in runs.tolist())
    best = min(listed, key=lambda r: (-r[1], r[0], r[2]))
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in listed)
    return (len(listed), *best, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join([words[i] for i in kept.tolist()])).hexdigest())


def _piece(texts: list[list[bytes]]) -> list[tuple]:
    """Results of some texts, worked on together."""
    sizes = np.array([len(t) for t in texts])
    number = np.fromiter(map(hash, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    wanted = repeats_four(number, text, len(texts))
    of: dict[int, np.ndarray] = {}
    if wanted.any():
        inner = wanted[text]
        chosen = np.flatnonzero(wanted)
        begin = np.concatenate([[0], np.cumsum(sizes[chosen])])
        which = np.repeat(np.arange(len(chosen)), sizes[chosen])
        runs = find_runs(number[inner], which, begin[which + 1])
        cut = np.searchsorted(runs[:, 0], begin)
        for k, doc in enumerate(chosen.tolist()):
            of[doc] = runs[cut[k]:cut[k + 1]] - np.array([begin[k], begin[k], 0])
    none = np.zeros((0, 3), np.int64)
    return [_result(t, of.get(k, none)) for k, t in enumerate(texts)]


NAMES = ["n_runs", "start", "length", "period", "runs_sha256", "collapsed_sha256"]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]


def _batches(loops: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (b"" if not t.is_valid else t.as_buffer().to_pybytes() for t in batch.column(1))
            rows, held, n = [], [], 0
            for doc, raw in zip(batch.column(0).to_pylist(), texts, strict=True):
                words = raw.split()  # of bytes: at space and 0x09 to 0x0D
                held.append(looped(words, doc) if loops and doc is not None else words)
                n += len(words)
                if n >= PIECE:
                    rows += _piece(held)
                    held, n = [], 0
            rows += _piece(held) if held else []
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in NAMES]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True))], names=["doc_id", *NAMES])
    return run


def periodic_runs(docs: DataFrame, loops: bool = False) -> DataFrame:
    """``(doc_id, n_runs, start, length, period, runs_sha256, collapsed_sha256)`` for each row of ``docs (doc_id, text)``.

    ``start``, ``length`` and ``period`` are those of the longest run, the first of equals; NULL without
    a run. ``runs_sha256`` is of all runs' ``start,length,period`` lines and ``collapsed_sha256`` of the text
    with each run cut to its first period, words joined by one space. ``loops`` first turns the tails of
    a tenth of the documents into loops (``looped``).

    A NULL or empty text has no words. Rows are independent: repeated ids and rows give a row each, a
    row without an id is never looped, an empty table gives an empty one. Memory follows the words of
    the longest text, some 400 bytes a word where it repeats. Other columns are not read.
    """
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(_batches(loops), "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
                                            "runs_sha256 string, collapsed_sha256 string")
