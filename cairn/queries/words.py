"""Scalar functions on text and values."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions import similarity, text, values
from cairn.operators import linkage
from cairn.operators.forest import fold, is_holdout
from cairn.queries import query

RULES = text.NameRules(
    substitutions=[(r"(?<=\W)RING(?=\W|\z)", "ROUND RING")],
    title_words=["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"],
    ignore_words=["RED", "BLUE"])

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("name_explode", f"""
    WITH items AS (SELECT doc_id, list_filter(list_transform(string_split(text, ','),
                       lambda x: trim(x, {_BLANKS})), lambda x: x <> '') AS xs FROM documents)
    SELECT doc_id, unnest(range(1, len(xs) + 1)) AS seq, unnest(xs) AS item FROM items""")
def name_explode(t):
    return (t("documents").select("doc_id", F.posexplode(text.comma_items(F.col("text"))))
            .select("doc_id", (F.col("pos") + 1).cast("bigint").alias("seq"),
                    F.col("col").alias("item")))


@query("name_normalise", """
    WITH tokens AS (
        SELECT p_partkey, list_filter(string_split(replace(
            upper(regexp_replace(p_name || '--' || p_type || '/' || p_size, '\\W+', ' ', 'g')) || ' ',
            ' RING ', ' ROUND RING '), ' '), lambda x: x NOT IN ('', 'RED', 'BLUE')) AS w
        FROM part)
    SELECT p_partkey,
        array_to_string(list_filter(w, lambda x: NOT (regexp_full_match(x, '[0-9]+') OR x IN
            ('ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'))), '') AS name,
        array_to_string(list_filter(w, lambda x: regexp_full_match(x, '[0-9]+') OR x IN
            ('ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD')), ' ') AS title
    FROM tokens""")
def name_normalise(t):
    raw = F.concat("p_name", F.lit("--"), "p_type", F.lit("/"), F.col("p_size").cast("string"))
    return t("part").select("p_partkey", text.name_and_title(raw, RULES).alias("n")).select(
        "p_partkey", "n.name", "n.title")


@query("text_classes", """
    WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS x
               FROM documents)
    SELECT doc_id, count(*) AS tokens,
           count(*) FILTER (regexp_full_match(x, '[\\x00-\\x7F]*')) AS ascii_tokens,
           count(*) FILTER (regexp_full_match(x, '[0-9]+')) AS digit_tokens
    FROM w GROUP BY doc_id""")
def text_classes(t):
    tokens = F.split("text", r"[ \t\n\r\f]+")
    return t("documents").select(
        "doc_id", F.size(tokens).cast("bigint").alias("tokens"),
        F.size(F.filter(tokens, text.is_ascii)).cast("bigint").alias("ascii_tokens"),
        F.size(F.filter(tokens, text.is_digits)).cast("bigint").alias("digit_tokens"))


@query("multi_split", """
    SELECT page_id, len(regexp_split_to_array(html, '[,;()]')) AS parts,
           list_max(list_transform(regexp_split_to_array(html, '[,;()]'), lambda x: length(x)))
               AS longest
    FROM pages""")
def multi_split(t):
    parts = text.split_any(F.col("html"))
    return t("pages").select(
        "page_id", F.size(parts).cast("bigint").alias("parts"),
        F.array_max(F.transform(parts, lambda x: F.length(x))).cast("bigint").alias("longest"))


@query("title_case", """
    WITH cased AS (
        SELECT conv_id, turn, array_to_string(list_transform(
            regexp_extract_all(lower(text), '\\p{L}+|\\P{L}+'),
            lambda x: replace(upper(x[1]), 'ẞ', 'Ss') || x[2:]), '') AS s
        FROM conversations)
    SELECT conv_id, turn, array_to_string(list_transform(list_filter(
        regexp_split_to_array(s, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> ''),
        lambda x: CASE WHEN x IN ('I','Ii','Iii','Iv','V','Vi','Vii') THEN upper(x) ELSE x END),
        ' ') AS title FROM cased""")
def title_case(t):
    return (t("conversations")
            .select("conv_id", "turn", text.title_case(F.col("text")).alias("title")))


@query("slug", """
    SELECT page_id, regexp_replace(upper(url), '[^A-Z]+|HIMAL|SUBSECTION', '', 'g') AS slug
    FROM pages""")
def slug(t):
    return t("pages").select("page_id", text.slug(F.col("url")).alias("slug"))


def _dms_sql(v: str, letters: str) -> str:
    u = f"CAST(round_even(abs({v}) * 10000000, 0) AS BIGINT)"
    m = f"(({u} % 10000000) * 60)"
    return (f"CASE WHEN {v} IS NOT NULL THEN printf('%d° %02d′ %08.5f″ %s', {u} // 10000000, "
            f"{m} // 10000000, ({m} % 10000000) * 60 / 10000000.0::DOUBLE, "
            f"CASE WHEN {v} < 0 THEN '{letters[1]}' ELSE '{letters[0]}' END) END")


@query("dms_text", f"""
    WITH p AS (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal / 70 END AS lon,
                      c_acctbal / 130 AS lat FROM customer)
    SELECT c_custkey, {_dms_sql('lon', 'EW')} AS dms_lon, {_dms_sql('lat', 'NS')} AS dms_lat,
           round_even(lat, 7) AS lat7 FROM p""")
def dms_text(t):
    points = t("customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal") / 70)
        .alias("lon"), (F.col("c_acctbal") / 130).alias("lat"))
    return points.select("c_custkey", values.dms(F.col("lon"), True).alias("dms_lon"),
                         values.dms(F.col("lat"), False).alias("dms_lat"),
                         values.half_even(F.col("lat"), 7).alias("lat7"))


@query("jaro_winkler", """
    SELECT p_partkey, round(jaro_winkler_similarity(p_name, p_type || ' ' || p_name), 6) AS jw,
           round(jaro_winkler_similarity(p_name, reverse(p_name)), 6) AS jw_reversed
    FROM part""")
def jaro_winkler(t):
    name = F.col("p_name")
    return t("part").select(
        "p_partkey",
        F.round(similarity.jaro_winkler(name, F.concat("p_type", F.lit(" "), name)), 6)
        .alias("jw"),
        F.round(similarity.jaro_winkler(name, F.reverse(name)), 6).alias("jw_reversed"))


# The older C-library form on pairs whose matches are known: a name and its beginning have all of the
# shorter one's letters in order, and a name whose last two letters are exchanged has all in reach.
@query("jaro_winkler_whole_prefix", """
    WITH p AS (SELECT p_partkey, p_name AS b, length(p_name) AS n, 1 + p_partkey % (length(p_name) - 2) AS k FROM part),
    j AS (SELECT p_partkey, n, k, (2 + k / n) / 3 AS beginning,
                 CASE WHEN b[n] = b[n - 1] THEN 1.0 ELSE (2 + (n - 1) / n) / 3 END AS exchanged FROM p)
    SELECT p_partkey, round(least(1, beginning + 0.1 * k * (1 - beginning)), 6) AS beginning,
           round(least(1, exchanged + 0.1 * (n - 2) * (1 - exchanged)), 6) AS exchanged FROM j""")
def jaro_winkler_whole_prefix(t):
    name, n = F.col("p_name"), F.length("p_name")
    parts = t("part").select(
        "p_partkey", "p_name", F.substring(name, F.lit(1), (1 + F.col("p_partkey") % (n - 2)).cast("int")).alias("beginning"),
        F.concat(F.substring(name, F.lit(1), n - 2), F.substring(name, n, F.lit(1)), F.substring(name, n - 1, F.lit(1)))
        .alias("exchanged"))
    return parts.select("p_partkey", *(
        F.round(similarity.jaro_winkler(F.col(c), name, **similarity.C_LIBRARY), 6).alias(c) for c in ("beginning", "exchanged")))


@query("jaccard_tokens", """
    WITH s AS (SELECT page_id, list_distinct(string_split(split_part(url, '/', 3), '.')) AS a,
                      list_distinct(regexp_extract_all(html, '[a-z]+')) AS b FROM pages)
    SELECT page_id, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6)
           AS jaccard FROM s""")
def jaccard_tokens(t):
    host = F.split(F.split_part("url", F.lit("/"), F.lit(3)), r"\.")
    words = F.regexp_extract_all("html", F.lit("([a-z]+)"), F.lit(1))
    return t("pages").select("page_id", F.round(similarity.jaccard(host, words), 6)
                             .alias("jaccard"))


_NAMES = "(SELECT p_name AS name, count(*) AS n FROM part GROUP BY 1)"


def gram_sql(source: str) -> str:
    """SQL of ``name, n, gram, tf`` for a ``(name, n)`` source."""
    return f"""(SELECT name, any_value(n) AS n, gram, count(*) AS tf FROM (
        SELECT name, n, unnest(list_concat(
            list_transform(range(1, length(name)), lambda i: lower(name)[i:i+1]),
            list_transform(range(1, length(name) - 1), lambda i: lower(name)[i:i+2]))) AS gram
        FROM {source}) GROUP BY name, gram)"""


def idf_sql(source: str) -> str:
    return f"""(SELECT gram, CAST(sum(n) AS BIGINT) AS df,
                       ln((1 + (SELECT sum(n) FROM {source})) / (1 + sum(n))) + 1 AS idf
                FROM {gram_sql(source)} GROUP BY gram)"""


def weight_sql(source: str, corpus: str) -> str:
    return f"""(SELECT name, gram, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY name))
                       AS w FROM {gram_sql(source)} JOIN {idf_sql(corpus)} USING (gram))"""


def _part_names(t):
    return linkage.distinct_names(t("part").select(F.col("p_name").alias("name")))


@query("char_ngrams", f"SELECT name, gram, tf FROM {gram_sql(_NAMES)}")
def char_ngrams(t):
    return (_part_names(t).select("name", F.explode(text.gram_counts(F.col("name"))).alias("g"))
            .select("name", "g.gram", F.col("g.tf").cast("bigint").alias("tf")))


@query("idf", f"SELECT gram, df, round(idf, 6) AS idf FROM {idf_sql(_NAMES)}")
def idf(t):
    return linkage.inverse_frequency(_part_names(t)).select(
        "gram", "df", F.round("idf", 6).alias("idf"))


@query("tfidf_norm", f"SELECT name, gram, round(w, 6) AS w FROM {weight_sql(_NAMES, _NAMES)}")
def tfidf_norm(t):
    names = _part_names(t)
    vectors = linkage.unit_vectors(names, linkage.inverse_frequency(names))
    return (vectors.select("name", F.explode(F.arrays_zip("grams", "weights")).alias("e"))
            .select("name", F.col("e.grams").alias("gram"), F.round("e.weights", 6).alias("w")))


def _bucket_sql(key: str, n: int) -> str:
    digits = f"list_transform(string_split(sha256({key}), ''), lambda c: strpos('0123456789abcdef', c) - 1)"
    return f"CAST(list_reduce({digits}, lambda a, x: (a * 16 + x) % {n}) % {n} + 1 AS INT)"


@query("hash_bucket", f"""
    SELECT o_orderkey, {_bucket_sql("o_orderkey || '-' || o_custkey", 97)} AS bucket FROM orders""")
def hash_bucket(t):
    return t("orders").select("o_orderkey", values.hash_bucket(
        [F.col("o_orderkey"), F.col("o_custkey")], 97).alias("bucket"))


@query("train_test_fold", f"""
    SELECT o_orderkey, {_bucket_sql("o_orderkey::VARCHAR", 5)} = 1 AS test_indicator,
           {_bucket_sql("o_orderkey::VARCHAR", 10)} AS fold FROM orders""")
def train_test_fold(t):
    key = [F.col("o_orderkey")]
    return t("orders").select("o_orderkey", is_holdout(key).alias("test_indicator"),
                              fold(key).alias("fold"))


@query("color_ramp", """
    WITH r AS (SELECT *, min(p) OVER () AS lo, max(p) OVER () AS hi FROM
               (SELECT p_partkey, p_retailprice / 20 AS p FROM part))
    SELECT p_partkey, CASE WHEN p BETWEEN 0 AND 100 THEN
        printf('hsl(%d %d%% %d%%)', CAST(floor(60 + (p - lo) / (hi - lo) * 85 + 0.5) AS INT), 100,
               CAST(floor(70 - (p - lo) / (hi - lo) * 50 + 0.5) AS INT))
        ELSE 'hsl(0 0% 100%)' END AS colour FROM r""")
def color_ramp(t):
    scored = t("part").select("p_partkey", (F.col("p_retailprice") / 20).alias("p"))
    ends = scored.agg(F.struct(F.min("p").alias("lower"), F.max("p").alias("upper"))).scalar()
    return scored.select("p_partkey", values.ramp_colour(F.col("p"), ends["lower"], ends["upper"])
                         .alias("colour"))
