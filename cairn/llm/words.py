"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays.

Texts come as Arrow string arrays. Bytes A-Z are lower-cased; words are runs of bytes outside
0x20 and 0x09 to 0x0D. Work goes in pieces of about a megabyte that end between words, so memory
is bounded by the batch and not multiplied by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_codes() -> np.ndarray:
    low = np.arange(256, dtype=np.uint64)
    low[65:91] += np.uint64(32)
    return mix((low + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))


_CODES = _byte_codes()
_KEYS = mix(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets where each begins; NULL is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Hashes of all words, text after text; text ``k`` has ``hashes[ends[k]:ends[k + 1]]``."""

    hashes: np.ndarray
    ends: np.ndarray

    def of(self, k: int) -> np.ndarray:
        return self.hashes[self.ends[k]:self.ends[k + 1]]


def word_hashes(column: pa.Array) -> Words:
    raw, offsets = text_bytes(column)
    cuts, at = [0], 0
    while at < len(raw):
        stop = min(at + PIECE, len(raw))
        while stop < len(raw) and not _SPACE[raw[stop]]:
            more = np.flatnonzero(_SPACE[raw[stop:stop + PIECE]])
            stop += int(more[0]) if len(more) else len(raw[stop:stop + PIECE])
        cuts.append(stop)
        at = stop
    hashes, starts = [], []
    for low, high in zip(cuts, cuts[1:], strict=False):
        found, where = _piece(raw[low:high], offsets[(offsets > low) & (offsets < high)] - low)
        hashes.append(found)
        starts.append(where + low)
    every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    places = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(every, np.searchsorted(places, offsets))


def _piece(raw: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in one piece; texts begin at its start and at the borders."""
    inside = ~_SPACE[raw]
    edge = np.empty(len(raw) + 1, bool)
    edge[0], edge[-1] = inside[0], inside[-1]
    edge[1:-1] = inside[1:] != inside[:-1]
    borders = np.unique(borders)
    both = borders[inside[borders] & inside[borders - 1]]  # a word ends and another one begins
    marks = np.sort(np.concatenate([np.flatnonzero(edge), both, both]))
    begin, end = marks[0::2], marks[1::2]
    power, inverse = _power_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_CODES[raw] * power[:len(raw)], out=total[1:])
    return mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64)), begin


def shingle_hashes(words: Words, size: int = 5) -> Words:
    """Hashes of all runs of ``size`` words, repeats included; a shorter text is one run as a whole."""
    counts = np.diff(words.ends)
    n = len(words.hashes)
    spread = np.zeros(max(0, n - size + 1), np.uint64)
    for j in range(size if len(spread) else 0):
        spread += words.hashes[j:n - size + 1 + j] * _KEYS[j]
    text = np.repeat(np.arange(len(counts)), counts)
    whole = text[:n - size + 1] == text[size - 1:] if len(spread) else np.zeros(0, bool)
    runs = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(runs)])
    out = np.empty(ends[-1], np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    full = np.ones(ends[-1], bool)
    full[ends[short]] = False
    out[full] = mix(spread[whole])
    for k in short:
        some = words.of(k)
        out[ends[k]] = mix((some * _KEYS[:len(some)]).sum(dtype=np.uint64, keepdims=True)
                           + np.uint64(len(some)))[0]
    return Words(out, ends)
