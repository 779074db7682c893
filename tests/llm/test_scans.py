"""Secret, licence and quality scans and decontamination against plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from cairn.llm import decontaminate, licences, quality, secrets


def python_spans(text):
    found = []
    for place, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), place, rule.kind, m.end()))
    return sorted(found)


def test_trigram_queries_follow_from_the_expressions():
    names = {"".join(sorted(s)) for s in secrets.trigram_query(secrets.BASE[0].pattern)[0]}
    assert len(names) == 6
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    assert secrets.trigram_query("[0-9a-f]{32,}") == []
    assert secrets.trigram_query("ab?cde|xy") == []
    assert secrets.trigram_query("x+abcd.*wxyz") == [[frozenset({"abc", "bcd"})], [frozenset({"wxy", "xyz"})]]


def test_spans_equal_a_full_scan(odd, odd_rows):
    rows = secrets.find_secrets(odd).collect()
    assert len(rows) == len(odd_rows)
    for row in rows:
        assert [tuple(s) for s in row["spans"]] == python_spans(row["text"])
    assert sum(bool(r["spans"]) for r in rows) >= 3


TRICKY = ["secret=token:abcdefghijk", "token=token=abcdefgh12", "api-key: abcdefgh apikey:'abcdefgh' API_KEY=short",
          "passwd=\"x\" passwd=\"xxxxxxxx\"", "AKIA AKIAAKIA AKIAAKIAAKIAAKIA", "0" * 31 + " " + "f" * 33 + "g",
          "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20, "日本 password=日本 password=abcdefgh日", "xoxb-1234567890",
          "eyJhbGciOiJI.eyJzdWIiOiIx.sig_na-ture", "AIza" + "x" * 35, "sk_live_" + "9" * 16, "TOKEN : 'abc.def=/+-_'"]


def test_tricky_spans(spark):
    rows = secrets.find_secrets(spark.createDataFrame(list(enumerate(TRICKY)), "doc_id bigint, text string")).collect()
    for row in rows:
        assert [tuple(s) for s in row["spans"]] == python_spans(row["text"]), row["text"]


def test_masking_leaves_the_rest(odd):
    for row in secrets.redact(secrets.find_secrets(odd.withColumn("before", F.col("text")))).collect():
        text, at, done = row["before"] or "", 0, ""
        for start, _, _, end in python_spans(text):
            if start >= at:
                done += text[at:start] + "[secret]"
            at = max(at, end)
        assert (row["text"] or "") == done + text[at:]


def python_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for number, (phrase, label) in enumerate(licences.BASE + licences.EXTRA):
        want = phrase.split(" ")
        found += [(number, label, k, len(want)) for k in range(len(words)) if words[k:k + len(want)] == want]
    return len(words), found


def test_licence_places_equal_a_full_scan(spark, odd):
    texts = ["MIT-License mit license, MIT LICENSE.", "the GNU General Public License, version 3 of the general public license",
             "general public general public license", "licensed under cc by-nc 4.0", "license mit", "mit\nlicense2 mit license"]
    docs = odd.unionByName(spark.createDataFrame([(90 + k, t) for k, t in enumerate(texts)], "doc_id bigint, text string"),
                           allowMissingColumns=True)
    rows = licences.scan_licences(docs.withColumn("before", F.col("text"))).collect()
    assert len(rows) == docs.count()
    for row in rows:
        n, places = python_places(row["before"])
        assert row["n_words"] == n
        assert sorted(tuple(p) for p in row["places"]) == sorted(places)
        assert 0 <= row["score"] <= 1 and (row["score"] == 1) == bool(places)


def python_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    inside = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_statistics(odd):
    short = odd.where("text IS NULL OR length(text) < 5000")
    for row in quality.text_statistics(short.withColumn("before", F.col("text"))).collect():
        assert (row["word_chars"], row["n_symbols"]) == python_statistics(row["before"])[1:3]
        assert (row["n_words"], row["n_dup_lines"], row["n_repeat_words"]) == tuple(
            python_statistics(row["before"])[k] for k in (0, 3, 4))


def test_both_ways_to_find_repeated_windows_agree(odd, monkeypatch):
    before = quality.text_statistics(odd).select("doc_id", "n_repeat_words").collect()
    monkeypatch.setattr(quality, "_FEW", 0)
    assert sorted(before, key=str) == sorted(quality.text_statistics(odd).select("doc_id", "n_repeat_words").collect(), key=str)


def test_verdicts_follow_the_group(spark):
    clean = [(k, " ".join(f"w{k}x{j}" for j in range(60)), "en", "a") for k in range(40)]
    noisy = [(100 + k, " ".join(f"w{k}x{j}##" for j in range(60)), "en", "b") for k in range(40)]
    odd_one = (200, " ".join(f"q{j}##" for j in range(60)), "en", "a")
    rows = {r["doc_id"]: r for r in quality.judge(
        spark.createDataFrame([*clean, *noisy, odd_one], "doc_id bigint, text string, lang string, source string")).collect()}
    assert all(rows[k]["kept"] for k, *_ in clean + noisy) and not rows[200]["kept"] and not rows[200]["base_failed"]


def test_sketches_merge(odd):
    stats = quality.text_statistics(odd)
    half = [quality.group_sketches(stats.where(f"coalesce(doc_id, 0) % 2 = {k}"), ["lang"]) for k in (0, 1)]
    merged = quality.merge_sketches(half[0].union(half[1]), ["lang"])
    assert sorted(merged.collect(), key=str) == sorted(quality.group_sketches(stats, ["lang"]).collect(), key=str)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_contained_items(spark, odd, odd_rows):
    long = odd_rows[10][1].split(" ")
    item = long[3000:3040]
    some = item[:8] + ["else"] + item[9:]
    items = [(1, " ".join(item)), (2, " ".join(some)), (3, "one"), (4, None), (5, ""), (None, odd_rows[16][1]),
             (1, " ".join(item)), (6, " ".join(long[100:112])), (7, " ".join(item[:20] + [f"z{k}" for k in range(20)]))]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.find_contaminated(odd, table).collect()
    wanted = set()
    for doc in odd_rows:
        for number, text in items:
            both, own = len(shingles(doc[1]) & shingles(text)), len(shingles(text))
            if own and 100 * both >= 75 * own:
                wanted.add((doc[0], number, both, own))
    assert {(r["doc_id"], r["item_id"], r["n_shared"], r["n_item"]) for r in rows} == wanted
    assert {w[1] for w in wanted} == {1, 2, 3, 6, None}
    left = decontaminate.remove_contaminated(odd, table)
    assert left.columns == odd.columns
    gone = {(w[0]) for w in wanted}
    assert left.count() == sum(r[0] not in gone for r in odd_rows if r[0] is not None) + sum(r[0] is None for r in odd_rows)


@pytest.mark.parametrize("scan", [secrets.find_secrets, licences.scan_licences, quality.judge])
def test_empty_tables(none, scan):
    assert scan(none).count() == 0


def test_empty_decontamination(odd, none):
    items = odd.selectExpr("doc_id AS item_id", "text")
    assert decontaminate.find_contaminated(none, items).count() == 0
    assert decontaminate.remove_contaminated(odd, items.where("false")).count() == odd.count()
