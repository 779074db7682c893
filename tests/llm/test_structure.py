"""Runs, tries of conversations and URL verdicts against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cairn.llm import periodic, scan, trie, urls
from cairn.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


# Runs -------------------------------------------------------------------------------------------

def runs_by_period(words):
    """All runs, period after period: the smallest one of a stretch wins."""
    found, w = {}, np.array([hash(x) for x in words], np.int64)
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate([[False], w[q:] == w[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True):
            if e + q - s >= max(12, 2 * q):
                found.setdefault((s, e + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def expected_runs(doc, text, loops=True):
    words = (text or "").encode().split()
    if loops and doc is not None:
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_by_period(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc, len(runs), *best, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def repetitive(rnd):
    """Random, looped, Fibonacci and nested texts of few words."""
    n, k, kind = rnd.randint(0, 160), rnd.randint(1, 4), rnd.randint(0, 4)
    words = [rnd.randrange(k) for _ in range(n)]
    if kind == 1 and n:
        p = rnd.randint(1, max(1, n // 2))
        words = [words[i % p] for i in range(n)]
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(n)] = rnd.randrange(k)
    elif kind == 2:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        words = b[:n]
    elif kind == 3:
        words = (([0, 1] * rnd.randint(1, 20) + [rnd.randrange(2)]) * 30)[:n]
    elif kind == 4:
        part, words = [rnd.randrange(2) for _ in range(rnd.randint(1, 6))], []
        while len(words) < n:
            words += part * rnd.randint(1, 6) + [rnd.randrange(2)] * rnd.randint(0, 3)
    return [f"w{x}" for x in words]


def test_runs_equal_those_found_period_by_period():
    rnd = random.Random(3)
    for _ in range(250):
        texts = [repetitive(rnd) for _ in range(rnd.randint(1, 6))]
        found = periodic._piece([[w.encode() for w in t] for t in texts])
        for words, row in zip(texts, found, strict=True):
            assert row == expected_runs(None, " ".join(words))[1:], words


def test_wavelet_tree_counts_and_orders():
    rnd = np.random.default_rng(1)
    values = rnd.permutation(500)[:300]
    tree = periodic.Wavelet(values)
    low = rnd.integers(0, 299, 200)
    high = np.minimum(300, low + rnd.integers(1, 100, 200))
    bound = rnd.integers(0, 700, 200)
    parts = [np.sort(values[a:b]) for a, b in zip(low, high, strict=True)]
    assert tree.below(low, high, bound).tolist() == [int((p < x).sum()) for p, x in zip(parts, bound, strict=True)]
    rank = np.array([rnd.integers(0, len(p)) for p in parts])
    assert tree.smallest(low, high, rank).tolist() == [int(p[r]) for p, r in zip(parts, rank, strict=True)]


def test_runs_in_one_very_long_text():
    rnd = random.Random(4)
    loop = [f"v{rnd.randrange(50)}" for _ in range(700)]
    words = loop * 20 + [f"u{rnd.randrange(9)}" for _ in range(6000)] + ["same"] * 20000
    assert periodic._piece([[w.encode() for w in words]])[0] == expected_runs(None, " ".join(words))[1:]


def test_runs_of_odd_rows(spark, odd, odd_rows, none):
    extra = [(10 ** 9, "a b " * 40, *[None] * 6), (-3, "x " * 13, *[None] * 6), (24, "one two three " * 30, *[None] * 6)]
    docs = odd.union(spark.createDataFrame(extra, odd.schema)).withColumn("n_runs", F.lit("clash"))
    for loops in (True, False):
        got = [tuple(r) for r in periodic.periodic_runs(docs, loops).collect()]
        assert sorted(got, key=repr) == sorted((expected_runs(r[0], r[1], loops) for r in odd_rows + extra), key=repr)
    assert periodic.periodic_runs(none).collect() == []


def test_runs_query(spark):
    rows = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r["doc_id"]: r for r in QUERIES["op13_runs"](spark, FOLDER).collect()}
    assert len(got) == len(rows)
    for row in rows:
        want, r = expected_runs(row["doc_id"], row["text"]), got[row["doc_id"]]
        assert (r["doc_id"], r["n_runs"], r["start"], r["length"], r["period"], r["runs_sha256"], r["collapsed_sha256"]) == want
        assert r["exponent_milli"] == (None if r["period"] is None else 1000 * r["length"] // r["period"])


# Running sums -----------------------------------------------------------------------------------

def test_running_sums_of_groups_over_several_ranges(spark):
    rnd = random.Random(6)
    rows = [(0, rnd.randint(0, 40), k) for k in range(3000)] + [(rnd.randint(1, 50), k % 7, k) for k in range(500)]
    rows += [(60, 1, 1)] * 800  # equal rows
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = scan.lay_out(spark.createDataFrame(rows, "g bigint, o bigint, v bigint"), "g", ["o"])
        spans = {r["g"]: r["n"] for r in laid.groupBy("g").agg(F.count_distinct(scan.PART).alias("n")).collect()}
        got = scan.running_sums(laid, "g", ["o"], {"at": F.lit(1), "total": F.col("v")}).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spans[0] > 2 and spans[60] > 1
    groups = defaultdict(list)
    for r in got:
        groups[r["g"]].append(r)
    for some in groups.values():
        some.sort(key=lambda r: r["at"])
        assert [r["at"] for r in some] == list(range(1, len(some) + 1))
        assert [r["o"] for r in some] == sorted(r["o"] for r in some)
        assert [r["total"] for r in some] == np.cumsum([r["v"] for r in some]).tolist()


# Conversations ----------------------------------------------------------------------------------

def expected_trie(rows):
    stored = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            stored[conv].append((turn is not None, turn or 0, (role or "", text or "")))
    stored = {c: [t[2] for t in sorted(x, key=lambda t: t[:2])] for c, x in stored.items()}

    def rebuilt(c):
        base = c - int(np.fmod(c, 5))
        h = zlib.crc32(str(c).encode()) % 9
        return tuple(stored.get(base, [])[:h]) + tuple(stored[c][h:])

    members, ends = defaultdict(list), defaultdict(list)
    for c in stored:
        turns = rebuilt(c)
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        n, saved, leaves = below.setdefault(node, [0, 0, 0])
        saved += (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        leaves += n == 0
        below[node] = [n, saved, leaves]
        if node:
            up = below.setdefault(node[:-1], [0, 0, 0])
            up[0], up[1], up[2] = up[0] + 1, up[1] + saved, up[2] + leaves
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), below[node][0], below[node][2],
                   below[node][1], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
                  for node, m in members.items())


COLUMNS = "conv_id bigint, turn bigint, role string, text string, depth string, n_convs string"


def grown(spark, rows):
    conv = F.col("conv")
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], COLUMNS)
    return sorted(tuple(r) for r in trie.prefix_trie(df, conv - conv % 5, F.crc32(conv.cast("string")) % 9).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def order_key(row):
    return tuple((x is not None, x) for x in row)


def conversations(seed):
    rnd = random.Random(seed)
    words = ["", "a", "b", "é", "a b", None]
    rows = []
    for c in [*rnd.sample(range(-12, 60), 35), 10 ** 12, 10 ** 12 + 1]:
        for t in range(rnd.choice([1, 2, 5, 9, 14])):
            rows.append((c, None if t == 0 else t, rnd.choice(["user", None]), rnd.choice(words)))
    return rows + [(None, 0, "user", "nobody")]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_rebuilding(spark, seed):
    rows = conversations(seed)
    assert sorted(grown(spark, rows), key=order_key) == sorted(expected_trie(rows), key=order_key)


def test_trie_with_repeated_rows_a_hot_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"{t}") for c in range(0, 300, 5) for t in range(6)]  # one conversation, sixty times
    rows += [(2, t, "user", f"{t % 3}") for t in range(400)] + [(7, t, "user", f"{t % 3}") for t in range(300)]
    rows += [(1, 3, "user", "again")] * 20
    assert sorted(grown(spark, rows), key=order_key) == sorted(expected_trie(rows), key=order_key)


def test_trie_without_rows_and_without_turns(spark):
    assert grown(spark, []) == []
    lone = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)  # its base is absent
    rows = [(lone, 0, "user", "gone")]
    assert grown(spark, rows) == expected_trie(rows)
    assert [r[:2] for r in grown(spark, rows)] == [(lone, 0)]


def test_trie_starts_again_after_a_collision(spark, monkeypatch):
    bases = trie._bases
    asked = []

    def weak(salt):
        asked.append(salt)
        return [1, 1, 1, 1] if salt == 0 else bases(salt)  # base 1: the order of turns does not count

    monkeypatch.setattr(trie, "_bases", weak)
    rows = [(c, t, "u", x) for c, text in ((11, "0123456789abXY"), (12, "0123456789abYX")) for t, x in enumerate(text)]
    assert sorted(grown(spark, rows), key=order_key) == sorted(expected_trie(rows), key=order_key)
    assert max(asked) > 0


# URLs -------------------------------------------------------------------------------------------

def spread_by_hand(edges, seeds, rounds):
    out = defaultdict(int)
    for (src, _), w in edges.items():
        out[src] += w
    state = dict(seeds)
    for _ in range(rounds):
        new = defaultdict(int)
        for host, mass in seeds.items():
            new[host] += int(np.floor(float(mass) * (1 - urls.KEEP)))
        for (src, dst), w in edges.items():
            new[dst] += int(np.floor(float(state.get(src, 0)) * urls.KEEP * (w / out[src])))
        state = new
    return state


PAGES = [
    (1, "https://good.org/a", '<a href="http://friend.net/x">f</a><a class=k HREF=//Friend.net>again</a>'),
    (2, "http://friend.net/x", "<a href='https://pal.net:80/'>p</a> http://text.net"),
    (3, "http://pal.net:80/y", None),
    (4, "http://spam.com/de/1", "<p>nothing</p>"),
    (5, "http://farm.net/1", '<a href="http://spam.com/de/1">s</a>'),
    (6, "http://feeder.net/1", '<a href="http://farm.net/1">s</a><a href="/own">o</a>'),
    (7, "HTTP://WWW.Example.ORG/es/q?x=/fr/", None), (8, "http://a.example.org/en/12", ""), (9, "http://example.org/en/2", ""),
    (10, "http://x.com/fr/z#t", ""), (11, "http://notorg/x", ""), (12, "http://org?q", ""), (13, "http://org/", ""),
    (14, None, "<a href='http://spam.com/'>"), (15, "mailto:x", None), (16, "", None), (17, "a://b://c/d", None),
    (18, "http://unknown.net", None), (19, "http://spam.com/en/9", ""), (20, "http://sub.farm.net/1", ""),
    (20, "http://sub.farm.net/1", ""), (21, "http://" + "a." * 5000 + "org/x", ""), (22, "http://1.2.3.4/x", ""),
]


def test_url_verdicts(spark):
    df = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id int, url string, html string, verdict string, host string")
    rows = urls.judge_urls(df).collect()
    assert len(rows) == len(PAGES)
    got = {r["page_id"]: r for r in rows}
    assert {k: (got[k]["host"], got[k]["path"], got[k]["rule"], got[k]["verdict"]) for k in (1, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17)} == {
        1: ("good.org", "/a", "org/", "allow"), 7: ("www.example.org", "/es/q", "example.org/es/", "block"),
        8: ("a.example.org", "/en/12", "example.org/en/1", "block"), 9: ("example.org", "/en/2", "org/", "allow"),
        10: ("x.com", "/fr/z", "com/fr/", "allow"), 11: ("notorg", "/x", None, "allow"), 12: ("org", "", None, "allow"),
        13: ("org", "/", "org/", "allow"), 14: ("", "", None, "allow"), 15: ("", "", None, "allow"),
        16: ("", "", None, "allow"), 17: ("b:", "//c/d", None, "allow")}
    # By links alone: trust reaches the friends of good.org, distrust those that lead to spam.com.
    assert {k: got[k]["verdict"] for k in (2, 3, 5, 6, 18, 19, 20, 21, 22)} == {
        2: "allow", 3: "allow", 5: "block", 6: "block", 18: "allow", 19: "block", 20: "block", 21: "allow", 22: "allow"}
    assert got[2]["trust"] > 0 == got[2]["distrust"] and got[5]["distrust"] > 0 == got[5]["trust"]


def test_host_masses_equal_plain_iteration(spark):
    rnd = random.Random(8)
    hosts = [f"{a}{b}.net" for a in ("", "www.", "x.y.") for b in "abcdefgh"] + ["g.org", "h.org", "s.com"]
    pages = [(rnd.choice(hosts), "".join(f'<a href="http://{rnd.choice(hosts)}/q">l</a>' for _ in range(rnd.randint(0, 4))),
              rnd.choice([None, None, "allow", "block"])) for _ in range(120)]
    df = spark.createDataFrame(pages, "host string, html string, verdict string")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in urls.host_masses(df, rounds=7).collect()}
    edges, seeds = defaultdict(int), (defaultdict(int), defaultdict(int))
    for host, html, verdict in pages:
        for dst in {x.split("/")[0] for x in html.split("http://")[1:]} - {host}:
            edges[host, dst] += 1
        if verdict:
            seeds[verdict == "block"][host] += 1
    for host in {p[0] for p in pages}:
        up = host.split(".")
        while len(up) > 2:
            a, b = ".".join(up), ".".join(up[1:])
            edges[a, b], edges[b, a], up = edges[a, b] | 0, edges[b, a] | 0, up[1:]
    ties = set()
    for host in {p[0] for p in pages}:
        up = host.split(".")
        while len(up) > 2:
            ties |= {(".".join(up), ".".join(up[1:])), (".".join(up[1:]), ".".join(up))}
            up = up[1:]
    for tie in ties:
        edges[tie] += 1
    for kind, way in enumerate((edges, {(b, a): w for (a, b), w in edges.items()})):
        total = sum(seeds[kind].values())
        start = {h: int(np.floor(float(urls.MASS) * (n / total))) for h, n in seeds[kind].items()}
        want = spread_by_hand(way, start, 7)
        assert {h: m[kind] for h, m in got.items() if m[kind]} == {h: m for h, m in want.items() if m}


def test_url_verdicts_without_pages_and_without_seeds(spark):
    df = spark.createDataFrame(PAGES, "page_id int, url string, html string")
    assert urls.judge_urls(df.where("false")).collect() == []
    assert {r["verdict"] for r in urls.judge_urls(df, rules=[]).collect()} == {"allow"}
