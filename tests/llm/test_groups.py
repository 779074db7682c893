"""Near copies, components and shards against plain Python."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cairn.llm import neardup, shards, words
from cairn.llm.components import components


def python_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def shingles(text):
    found = python_words(text)
    return {tuple(found[k:k + 5]) for k in range(max(1, len(found) - 4))} if found else set()


def python_components(rows):
    """Smallest id reachable over links, by brute force over all pairs of distinct ids with text."""
    label = {d: d for d, _ in rows if d is not None}
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("piece", [40, 1 << 20])
def test_words(monkeypatch, piece):
    monkeypatch.setattr(words, "PIECE", piece)
    texts = ["Hello World", "", None, "a", " x  y\t", "ab", "cd", "É é", "x" * 150 + " k", "one two three four five six", "hello\x0bworld\x1c"]
    found = words.word_hashes(pa.array(texts))
    names = {}
    for k, text in enumerate(texts):
        assert len(found.of(k)) == len(python_words(text))
        for word, value in zip(python_words(text), found.of(k).tolist(), strict=True):
            assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)
    runs = words.shingle_hashes(found)
    assert [len(set(runs.of(k).tolist())) for k in range(len(texts))] == [len(shingles(t)) for t in texts]


def test_estimates_are_near_the_truth():
    rnd = np.random.default_rng(1)
    for n, sketch in ((60, neardup.sketch_few), (400, neardup.sketch_many), (5000, neardup.sketch_many)):
        for share in (0.5, 0.75, 0.9):
            both = round(2 * n * share / (1 + share))
            pool = rnd.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            a, b = pool[:n], pool[n - both:2 * n - both]
            got = neardup.similarity(sketch(a)[None], sketch(b)[None], np.array([n]), np.array([n]), neardup.MANTISSA)[0]
            assert abs(got - both / (2 * n - both)) < 0.12
    assert abs(neardup.similarity(sketch(pool[:n])[None], sketch(pool[n:])[None], np.array([n]), np.array([n]), 10)[0]) < 0.02


def test_near_copies(spark, odd, odd_rows):
    rows = neardup.near_duplicates(odd).collect()
    label = python_components([r[:2] for r in odd_rows])
    assert len(rows) == len(odd_rows)
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["component_id"], r["kept"]) == (label[r["doc_id"]], label[r["doc_id"]] == r["doc_id"])
    sizes = sorted(len(shingles(r[1])) for r in odd_rows)
    assert sorted(r["n_shingles"] for r in rows) == sizes


def test_chains_and_groups(spark):
    """Chains whose ends are no copies, a large group of near copies, and short texts with one passage."""
    rnd = random.Random(3)
    vocabulary = [f"w{k}" for k in range(4000)]
    rows, at = [], 0
    for _ in range(5):
        text = rnd.choices(vocabulary, k=140)
        for _ in range(7):
            rows.append((at, " ".join(text)))
            at += 1
            for k in rnd.sample(range(140), 2):
                text[k] = rnd.choice(vocabulary)
    base = rnd.choices(vocabulary, k=300)
    for _ in range(60):
        text = list(base)
        text[rnd.randrange(300)] = rnd.choice(vocabulary)
        rows.append((at, " ".join(text)))
        at += 1
    passage = rnd.choices(vocabulary, k=60)
    for _ in range(40):
        rows.append((at, " ".join(passage + rnd.choices(vocabulary, k=rnd.randint(5, 60)))))
        at += 1
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    label = python_components(rows)
    assert {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()} == label


def test_components(spark):
    rnd = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 30)] + [(299, 200 + k) for k in range(40)]
    edges += [(rnd.randrange(400, 460), rnd.randrange(400, 460)) for _ in range(30)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    apart = {n for e in edges for n in e} - {n for e in edges if e[0] != e[1] for n in e}
    assert {r["node"]: r["label"] for r in got} == {k: v for k, v in label.items() if k not in apart}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_empty_near_copies(none):
    assert neardup.near_duplicates(none).count() == 0


def test_differencing():
    sizes = [8, 7, 6, 5, 4]
    loads, places = shards.differencing([[s, 0] for s in sizes])
    assert sorted(loads) == [14, 16]
    sums = [0, 0]
    for size, place in zip(sizes, places, strict=True):
        sums[place[0]] += size
    assert sums == loads
    loads, places = shards.differencing([[5, 3, 1], [4, 4, 0]], kinds=[0, 0, 1])
    assert loads[2] == 1 and sorted(places[1][:2]) == [0, 1]


def check_shards(rows, got, spread):
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    for some in by.values():
        assert sorted(r["slot"] for r in some) == list(range(len(some)))
    homes = {}
    for r in got:
        homes.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    want = sorted((zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for _, t in rows)
    assert sorted((r["text_crc32"], r["size"]) for r in got) == want
    sums = sorted(sum(r["size"] for r in by.get(k, [])) for k in range(16))
    assert spread(sums), sums


def test_shards(spark, odd, odd_rows):
    got = shards.shard_documents(odd).collect()
    check_shards([r[:2] for r in odd_rows], got, lambda sums: True)
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in odd_rows)


@pytest.mark.parametrize("heavy", [4, 256])
def test_a_text_with_a_third_of_all_rows(spark, monkeypatch, heavy):
    monkeypatch.setattr(shards, "HEAVY", heavy)
    monkeypatch.setattr(shards, "CHUNK", 40)
    monkeypatch.setattr(shards, "FAN_IN", 4)
    rnd = random.Random(4)
    rows = [(k, "hot " * 20) for k in range(300)] + [(1000 + k, "x" * rnd.randint(1, 400) + str(k)) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    check_shards(rows, shards.shard_documents(docs).collect(), lambda sums: sums[14] - sums[0] < 0.01 * sums[0])


def test_empty_shards(none):
    assert shards.shard_documents(none).count() == 0
