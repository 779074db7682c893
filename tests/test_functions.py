"""Scalar functions against values worked out by hand."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cairn.functions import similarity, text, values


def one(spark, column, value):
    df = spark.createDataFrame([(value,)], "v STRING")
    return df.select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw, name, title", [
    ("Peak 41", "", "41"),
    ("Nuptse SE", "NUPTSE", "SOUTH EAST"),
    ("Nuptse NE II", "NUPTSE", "NORTH EAST II"),
    ("X Kang", "XKHANG", ""),
    ("Kangchenjunga", "KANGCHENJUNGA", ""),
    ("Baden-Powell Himal", "BADENPOWELL", ""),
    ("Éa Central", "ÉA", "CENTRAL"),
    ("Seti", "SETI", ""),
    ("", "", ""),
])
def test_name_and_title(spark, raw, name, title):
    got = one(spark, text.name_and_title, raw)
    assert (got["name"], got["title"]) == (name, title)


@pytest.mark.parametrize("raw, expected", [
    ("baden-powell", "Baden-Powell"), ("  nuptse   ii ", "Nuptse II"), ("o'neil's vii", "O'Neil'S VII"),
    ("peak 29b", "Peak 29B"), ("IVY iv", "Ivy IV")])
def test_title_case(spark, raw, expected):
    assert one(spark, text.title_case, raw) == expected


def test_slug_and_comma_items(spark):
    assert one(spark, text.slug, "Kutang Himal (north) 2 Subsection") == "KUTANGNORTH"
    assert one(spark, text.comma_items, " a ,, b\n,c d,") == ["a", "b", "c d"]
    assert one(spark, text.comma_items, "") == []


@pytest.mark.parametrize("value, lon, expected", [
    (83.9671962, True, "83° 58′ 01.90632″ E"), (28.5296673, False, "28° 31′ 46.80228″ N"),
    (86.9463465, True, "86° 56′ 46.84740″ E"), (-0.5, False, "0° 30′ 00.00000″ S"),
    (-122.0000001, True, "122° 00′ 00.00036″ W"), (None, True, None)])
def test_dms(spark, value, lon, expected):
    df = spark.createDataFrame([(value,)], "v DOUBLE")
    assert df.select(values.dms(F.col("v"), lon).alias("r")).first()["r"] == expected


def test_hash_bucket_is_the_digest_modulo(spark):
    keys = [(f"EXP{i}", f"{i % 7:02d}") for i in range(500)]
    df = spark.createDataFrame(keys, "a STRING, b STRING")
    rows = df.select("a", "b", *[values.hash_bucket([F.col("a"), F.col("b")], n).alias(f"n{n}")
                                 for n in (5, 10, 97)]).collect()
    for r in rows:
        number = int(hashlib.sha256(f"{r.a}-{r.b}".encode()).hexdigest(), 16)
        assert [r.n5, r.n10, r.n97] == [number % n + 1 for n in (5, 10, 97)]
    # A holdout of one in five covers the ten-folds 1 and 6 exactly.
    assert all((r.n5 == 1) == (r.n10 in (1, 6)) for r in rows)


def test_char_ngrams(spark):
    assert one(spark, text.char_ngrams, "AbCd") == ["ab", "bc", "cd", "abc", "bcd"]
    assert one(spark, text.char_ngrams, "A") == []
    counted = one(spark, text.gram_counts, "aaab")
    assert {(g["gram"], g["tf"]) for g in counted} == {("aa", 2), ("ab", 1), ("aaa", 1), ("aab", 1)}


def plain_jaro_winkler(a, b, weight, cap, boost_above, wide):
    if wide and len(a) > len(b):
        a, b = b, a
    reach = (min(len(a), len(b)) + 1) // 2 if wide else max(max(len(a), len(b)) // 2 - 1, 0)
    taken, pairs = set(), []
    for j, ch in enumerate(b):
        for i, other in enumerate(a):
            if i not in taken and other == ch and abs(i - j) <= reach:
                taken.add(i)
                pairs.append((i, j))
                break
    if not pairs:
        return 0.0
    m = len(pairs)
    order = [i for i, _ in pairs]
    if wide:
        swaps = sum(x != y for x, y in zip(order, sorted(order))) / 2
    else:
        swaps = sum(a[x] != a[y] for x, y in zip(order, sorted(order))) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    prefix = prefix if cap is None else min(prefix, cap)
    return min(jaro + prefix * weight * (1 - jaro), 1.0) if jaro > boost_above else jaro


@pytest.mark.parametrize("options, plain", [
    (similarity.STANDARD, (0.1, 4, 0.7, False)), (similarity.C_LIBRARY, (0.1, None, -1.0, True))])
def test_jaro_winkler_against_plain_loop(spark, options, plain):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ABÉ") for _ in range(rng.randint(0, 9)))
    pairs = [(word(), word()) for _ in range(3000)] + [("MARTHA", "MARHTA"), ("DIXON", "DICKSONX")]
    df = spark.createDataFrame(pairs, "a STRING, b STRING")
    got = df.select("a", "b", similarity.jaro_winkler(F.col("a"), F.col("b"), **options).alias("s"))
    for r in got.collect():
        assert r.s == pytest.approx(plain_jaro_winkler(r.a, r.b, *plain), abs=1e-12), (r.a, r.b)


def test_known_jaro_winkler_values(spark):
    df = spark.createDataFrame([("MARTHA", "MARHTA"), (None, "A")], "a STRING, b STRING")
    got = [r[0] for r in df.select(similarity.jaro_winkler(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(0.9611111) and got[1] is None


def test_blended_similarity_counts_title_repeats(spark):
    df = spark.createDataFrame(
        [("", "NORTH"), ("NORTH", "NORTH"), ("I I", "I"), ("NORTH EAST", "EAST II")],
        "l STRING, r STRING")
    got = [r[0] for r in df.select(similarity.blended(
        F.lit(0.8), F.lit(0.6), F.col("l"), F.col("r"))).collect()]
    assert got == pytest.approx([0.7, 0.1 + 0.9 * 0.7, 0.2 + 0.8 * 0.7, 0.2 / 3 + 0.8 * 0.7])


def test_jaccard_of_empty_sets_is_zero(spark):
    df = spark.createDataFrame([([], []), (["a", "a"], ["a", "b"])], "l ARRAY<STRING>, r ARRAY<STRING>")
    assert [r[0] for r in df.select(similarity.jaccard(F.col("l"), F.col("r"))).collect()] == [0.0, 0.5]


def test_ramp_colour(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (-1.0,), (float("nan"),), (None,)], "v DOUBLE")
    got = [r[0] for r in df.select(values.ramp_colour(F.col("v"), F.lit(0.0), F.lit(10.0))).collect()]
    white = "hsl(0 0% 100%)"
    assert got == ["hsl(60 100% 70%)", "hsl(103 100% 45%)", "hsl(145 100% 20%)", white, white, white]
    flat = df.select(values.ramp_colour(F.col("v"), F.lit(5.0), F.lit(5.0))).first()[0]
    assert flat == white


def test_first_source_takes_all_fields_of_one_source(spark):
    df = spark.createDataFrame([(None, "a1", 2.0, "b2"), (1.0, None, 2.0, "b2")],
                               "ax DOUBLE, at STRING, bx DOUBLE, bt STRING")
    got = df.select(values.first_source([
        (F.col("ax").isNotNull(), {"x": F.col("ax"), "t": F.col("at")}),
        (F.col("bx").isNotNull(), {"x": F.col("bx"), "t": F.col("bt")})]).alias("c")).select("c.*")
    assert [tuple(r) for r in got.collect()] == [(2.0, "b2"), (1.0, None)]


def test_title_case_of_any_script(spark):
    for raw, want in (("élan vÉri l'été", "Élan Véri L'Été"), ("ßa o'ß", "Ssa O'Ss"), ("ЯК-ii як", "Як-Ii Як")):
        assert one(spark, text.title_case, raw) == want


def test_combining_marks_part_words(spark):
    assert one(spark, text.word_text, "नेपाल x_1") == "न प ल X_1"
