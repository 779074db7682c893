"""The corpus operators on the test tables, with the SQL that gives the same answers."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import (bpe, decontaminate, html, language, licences, lm, neardup, periodic, quality,
                       secrets, shards, trie, urls)
from cairn.session import tune

VOCABULARY = os.environ.get("CAIRN_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.json")

#: Rows in one Arrow batch: texts are long, and a batch is held several times on its way.
BATCH_ROWS = 1000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """The settings that all queries here rely on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def query(name: str, table: str = "documents", sql: str | None = None):
    """Register a function ``table -> DataFrame``; one with a folder argument gets that too."""
    def register(fn: Callable):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            rows = spark.read.parquet(f"{folder}/{table}.parquet")
            return fn(rows, folder) if fn.__code__.co_argcount > 1 else fn(rows)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def long(column: Column, name: str) -> Column:
    return column.cast("bigint").alias(name)


def _span_sql() -> str:
    parts = []
    for place, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT r, {place} AS place, '{rule.kind}' AS kind, start, start + length(hits[k]) AS stop FROM (
    SELECT r, hits, part, k, (list_sum(list_transform(gaps[1:k], lambda x: length(x)))
           + coalesce(list_sum(list_transform(hits[1:k-1], lambda x: length(x))), 0))::BIGINT AS start
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM (
      SELECT r, string_split_regex(t, '{pattern}') AS gaps,
             regexp_extract_all(t, '{pattern}') AS hits,
             regexp_extract_all(t, '{pattern}', {rule.group}) AS part FROM d)))
  WHERE length(part[k]) >= {rule.least}""")
    return " UNION ALL ".join(parts)


@query("op4_secrets", sql=f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({_span_sql()}),
g AS (SELECT r, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
             count(*) FILTER (place = 2) AS n_hex,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place)
               FILTER (place < 3) AS base FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)""")
def op4_secrets(docs):
    found = secrets.find_secrets(docs.select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda x: x["place"] < len(secrets.BASE))
    def of(place: int) -> Column:
        return F.filter("spans", lambda x: x["place"] == place)

    counts = [long(F.size(of(i)), f"n_{rule.kind}") for i, rule in enumerate(secrets.BASE)]
    return found.select("doc_id", *counts, F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


def _phrase_sql() -> str:
    parts = []
    for number, (phrase, label) in enumerate(licences.BASE + licences.EXTRA):
        words = "[" + ", ".join(f"'{w}'" for w in phrase.split(" ")) + "]"
        size = len(phrase.split(" "))
        parts.append(f"SELECT {number} AS p, '{label}' AS label, {words} AS ws, {size} AS size")
    return " UNION ALL ".join(parts)


@query("op5_licences", sql=f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
t AS ({_phrase_sql()}),
v AS (SELECT DISTINCT unnest(ws) AS word FROM t),
h AS (SELECT DISTINCT r, word FROM (SELECT r, unnest(words) AS word FROM w) JOIN v USING (word)),
i AS (SELECT word, ln((1.0 + (SELECT count(*) FROM w)) / (1 + count(r))) + 1 AS idf
      FROM v LEFT JOIN h USING (word) GROUP BY word),
tw AS (SELECT DISTINCT p, unnest(ws) AS word FROM t),
tt AS (SELECT p, sum(idf) AS whole FROM tw JOIN i USING (word) GROUP BY p),
sh AS (SELECT r, max(s / whole) AS share FROM (
         SELECT r, p, sum(idf) AS s FROM h JOIN tw USING (word) JOIN i USING (word) GROUP BY r, p)
       JOIN tt USING (p) GROUP BY r),
o AS (SELECT r, p, label, size, unnest(list_filter(range(len(words) - size + 1),
             lambda k: words[k + 1:k + size] = ws)) AS start FROM w, t
      WHERE list_has_all(words, ws)),
g AS (SELECT r, count(*) FILTER (p < 3) AS n_base, min(start) FILTER (p < 3) AS first_word,
             max(start) FILTER (p < 3) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (p < 3) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM o GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN labels IS NOT NULL THEN 1.0 ELSE coalesce(round(share / 2, 6), 0.0) END::DOUBLE AS score
FROM w LEFT JOIN g USING (r) LEFT JOIN sh USING (r)""")
def op5_licences(docs):
    found = licences.scan_licences(docs.select("doc_id", "text"))
    base = F.filter("places", lambda x: x["phrase"] < len(licences.BASE))
    starts = F.transform("base", lambda x: x["start"].cast("bigint"))
    labels = [F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda x: x["label"]))), ",")
              .alias(n) for c, n in (("base", "base_labels"), ("places", "labels"))]
    return found.withColumn("base", base).select(
        "doc_id", "n_words", long(F.size("base"), "n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), *labels, "score")


@query("op6_quality", sql=f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
p AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
      FROM w),
x AS (SELECT r, unnest(range(len(words) - 2)) AS i, unnest(list_transform(range(len(words) - 2),
        lambda i: words[i+1] || ' ' || words[i+2] || ' ' || words[i+3])) AS g FROM p WHERE len(words) > 2),
y AS (SELECT r, i FROM x JOIN (SELECT r, g FROM x GROUP BY r, g HAVING count(*) > 1) USING (r, g)),
z AS (SELECT r, count(DISTINCT i + k) AS n FROM y, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
s AS (SELECT p.r, doc_id, lang, source, len(words)::BIGINT AS n_words,
             (length(t) - len(regexp_extract_all(t, '[\\x20\\x09-\\x0D]')))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             len(lines) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words FROM p LEFT JOIN z USING (r)),
q AS (SELECT *, n_symbols / greatest(word_chars, 1) AS symbol_rate,
             greatest(n_dup_lines - 1, 0) / greatest(n_lines, 1) AS line_rate,
             n_repeat_words / greatest(n_words, 1) AS repeat_rate FROM s),
b AS (SELECT r, lang, source, rate, floor(v * {quality.BINS})::INT AS bin FROM q
      UNPIVOT (v FOR rate IN (symbol_rate, line_rate, repeat_rate))),
c AS (SELECT lang, source, rate,
             quantile_disc(bin, 0.25) AS low, quantile_disc(bin, 0.75) AS high FROM b GROUP BY ALL),
m AS (SELECT lang, source, rate, greatest((high + 1 + {quality.REACH} * greatest(high - low, high / 8, 10.0::DOUBLE)) / {quality.BINS},
             CASE rate WHEN 'symbol_rate' THEN {quality.FLOORS["symbol_rate"]} ELSE 0.3 END) AS most FROM c),
f AS (SELECT r, bool_or(v > most) AS above FROM q
      UNPIVOT (v FOR rate IN (symbol_rate, line_rate, repeat_rate)) u JOIN m
      ON u.rate = m.rate AND u.lang IS NOT DISTINCT FROM m.lang AND u.source IS NOT DISTINCT FROM m.source
      GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT above AS kept
FROM q JOIN f USING (r)""")
def op6_quality(docs):
    return quality.judge(docs.select("doc_id", "text", "lang", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@query("op2_neardup", sql="""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(len(words) - 4), lambda i: array_to_string(words[i+1:i+5], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (g)
      WHERE a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON u = x.doc_id JOIN n y ON v = y.doc_id
      WHERE 100 * c >= 75 * (x.n + y.n - c)),
f AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, f.v FROM r JOIN f ON r.b = f.u)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.m AS component_id, w.doc_id = c.m AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) c ON c.a = w.doc_id""")
def op2_neardup(docs):
    return neardup.near_duplicates(docs.select("doc_id", "text"))


@query("op8_bpe")
def op8_bpe(docs):
    document = Path(VOCABULARY).read_text(encoding="utf-8")
    done = bpe.encode_documents(docs.select("doc_id", "text"), document, decoded=True)
    return done.select(
        "doc_id", long(F.size("ids"), "n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op1_language")
def op1_language(docs):
    rows = docs.select("doc_id", "text", "lang", language.held_out(F.col("doc_id")).alias("held_out"))
    model = language.learn(rows.where("NOT held_out"))
    return language.identify(rows.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


@query("op10_shards")
def op10_shards(docs):
    return shards.shard_documents(docs.select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op3_html", "pages", sql="""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''),
    '(?s)<article>(.*)</article>', 1), '<[^>]*>', ' ', 'g') AS t FROM pages),
d AS (SELECT page_id, url, regexp_replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'),
    '&quot;', '"'), '&#x27;', chr(39)), '&amp;?', '&', 'g') AS t FROM a),
c AS (SELECT page_id, url, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS text FROM d)
SELECT page_id, url, text, length(text) AS n_chars FROM c""")
def op3_html(pages):
    return html.extract_pages(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", long(F.length("text"), "n_chars"))


@query("op7_decontamination", sql="""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS words FROM benchmark),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(greatest(len(words) - 4, 1)),
        lambda i: array_to_string(words[i+1:i+5], ' '))) AS g FROM w WHERE len(words) > 0),
t AS (SELECT DISTINCT item_id, unnest(list_transform(range(greatest(len(words) - 4, 1)),
        lambda i: array_to_string(words[i+1:i+5], ' '))) AS g FROM b WHERE len(words) > 0),
n AS (SELECT item_id, count(*) AS n_item FROM t GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM s JOIN t USING (g) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM c JOIN n USING (item_id) WHERE n_shared * 100 >= n_item * 75""")
def op7_decontamination(docs, folder):
    items = docs.sparkSession.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate.find_contaminated(docs, items).groupBy("doc_id", "item_id", "n_item").agg(
        F.max("n_shared").alias("n_shared")).withColumn("containment", F.col("n_shared") / F.col("n_item"))


@query("op9_lm")
def op9_lm(docs):
    rows = docs.select("doc_id", "text", language.held_out(F.col("doc_id"), 10).alias("held_out"))
    model = lm.learn(rows.where("NOT held_out"))
    return lm.score_documents(rows, model).select(
        "doc_id", language.held_out(F.col("doc_id"), 10).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.filter.total).cast("bigint").alias("train_tokens"), "base_score", "score")


def _case_sql(part: str) -> str:
    ranked = sorted(urls.RULES, key=lambda r: -len(r.text))
    return "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, part)}'"
        for r in ranked) + " END"


def _rounds_sql() -> str:
    parts = []
    for k in range(1, urls.ROUNDS + 1):
        parts.append(f"""h{k} AS MATERIALIZED (SELECT kind, host, sum(mass)::BIGINT AS mass FROM (
    SELECT kind, host, floor(mass::DOUBLE * (1 - {urls.KEEP}::DOUBLE))::BIGINT AS mass FROM h0
    UNION ALL SELECT s.kind, e.dst, floor(s.mass::DOUBLE * {urls.KEEP}::DOUBLE * e.share)::BIGINT
    FROM h{k - 1} s JOIN e ON s.kind = e.kind AND s.host = e.src) GROUP BY kind, host)""")
    return ",\n".join(parts)


@query("op12_urls", "pages", sql=f"""
WITH p AS (SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '{urls.URL}', 1), '{urls.UPPER}', '{urls.LOWER}') AS host,
                  regexp_extract(coalesce(url, ''), '{urls.URL}', 2) AS path FROM pages),
q AS (SELECT *, {_case_sql("text")} AS rule, {_case_sql("verdict")} AS ruled FROM p),
seen AS (SELECT host, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b
         FROM q WHERE host <> '' GROUP BY host),
l AS (SELECT src, dst, count(*) AS w FROM (SELECT host AS src, unnest(list_distinct(list_transform(
        regexp_extract_all(html, '{urls.LINK.replace("'", "''")}', 1), lambda x: translate(x, '{urls.UPPER}', '{urls.LOWER}')))) AS dst FROM q)
      WHERE src <> dst AND src <> '' GROUP BY ALL),
u AS (SELECT string_split(host, '.') AS labels, unnest(range(1, len(string_split(host, '.')) - 1)) AS k FROM seen
      WHERE length(host) <= {urls.LONGEST_NAME} AND NOT regexp_matches(host, '^[0-9.:\\[\\]]+$')),
t AS (SELECT DISTINCT array_to_string(labels[k:], '.') AS src, array_to_string(labels[k + 1:], '.') AS dst FROM u),
w AS (SELECT src, dst, sum(w) AS w FROM (SELECT * FROM l UNION ALL SELECT src, dst, 1 FROM t UNION ALL SELECT dst, src, 1 FROM t) GROUP BY ALL),
d AS (SELECT 0 AS kind, src, dst, w FROM w UNION ALL SELECT 1, dst, src, w FROM w),
e AS MATERIALIZED (SELECT kind, src, dst, w::DOUBLE / (sum(w) OVER (PARTITION BY kind, src))::DOUBLE AS share FROM d),
h0 AS MATERIALIZED (SELECT 0 AS kind, host, floor({urls.MASS}::DOUBLE * (a::DOUBLE / (SELECT sum(a) FROM seen)::DOUBLE))::BIGINT AS mass FROM seen WHERE a > 0
       UNION ALL SELECT 1, host, floor({urls.MASS}::DOUBLE * (b::DOUBLE / (SELECT sum(b) FROM seen)::DOUBLE))::BIGINT FROM seen WHERE b > 0),
{_rounds_sql()},
m AS (SELECT host, coalesce(sum(mass) FILTER (kind = 0), 0)::BIGINT AS trust,
             coalesce(sum(mass) FILTER (kind = 1), 0)::BIGINT AS distrust FROM h{urls.ROUNDS} GROUP BY host)
SELECT page_id, q.host, path, rule,
       coalesce(ruled, CASE WHEN distrust > {urls.THRESHOLD}::DOUBLE * trust THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM q LEFT JOIN m USING (host)""")
def op12_urls(pages):
    return urls.judge_urls(pages.select("page_id", "url", "html")).select(
        "page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def _crc_sql(text: str) -> str:
    """CRC-32 of a text of ASCII characters."""
    step = "list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {step}), 4294967295)"


@query("op11_trie", "conversations", sql=f"""
WITH t AS (SELECT conv_id AS c, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS turn,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT c, list(turn ORDER BY pos) AS ts FROM t GROUP BY c),
h AS (SELECT c, ts, {_crc_sql("c::VARCHAR")} % 9 AS h FROM l),
b AS (SELECT h.c, coalesce(l.ts[1:h], []) || h.ts[h + 1:] AS ts FROM h LEFT JOIN l ON l.c = h.c - h.c % 5),
m AS (SELECT c, d, CASE WHEN d = 0 THEN '' ELSE sha256(to_json(ts[1:d])::VARCHAR) END AS k,
             CASE WHEN d = 0 THEN 0 ELSE strlen(ts[d].t) END AS bytes, len(ts) AS whole
      FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM b)),
n AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved,
             coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = whole), '') AS ends FROM m GROUP BY d, k),
p AS (SELECT n.d, n.k, any_value(q.k) AS pk FROM n JOIN m x ON x.c = n.conv_id AND x.d = n.d
      JOIN m q ON q.c = n.conv_id AND q.d = n.d - 1 GROUP BY ALL),
y AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM p GROUP BY ALL),
s AS (SELECT a.d, a.k, sum(n.saved) AS saved_tokens, count(*) FILTER (y.n_children IS NULL) AS n_leaves
      FROM n LEFT JOIN y ON n.d = y.d AND n.k = y.k JOIN m a ON a.c = n.conv_id AND a.d <= n.d GROUP BY a.d, a.k)
SELECT n.conv_id, n.d::BIGINT AS depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(y.n_children, 0) AS n_children,
       s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n LEFT JOIN p ON n.d = p.d AND n.k = p.k LEFT JOIN n o ON o.d = n.d - 1 AND o.k = p.pk
LEFT JOIN y ON n.d = y.d AND n.k = y.k JOIN s ON s.d = n.d AND s.k = n.k""")
def op11_trie(turns):
    conv = F.col("conv")
    return trie.prefix_trie(turns, conv - conv % 5, F.crc32(conv.cast("string")) % 9)


@query("op13_runs")
def op13_runs(docs):
    return periodic.periodic_runs(docs.select("doc_id", "text"), loops=True).select(
        "doc_id", "n_runs", "start", "length", "period",
        F.floor(1000 * F.col("length") / F.col("period")).cast("bigint").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
