"""Joins, filters, flags and duplicate handling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cairn.functions.values import first_source
from cairn.operators import quality, relational as rel
from cairn.operators.forest import accuracy
from cairn.plans import golden, warehouse
from cairn.queries import query
from cairn.session import scratch_folder
from cairn.sources import elements as el, layouts
from cairn.sources.tables import rows_since


def _expedition_rows(t):
    """Orders as expeditions."""
    flag = F.col("o_orderstatus")
    return t("orders").select(
        F.col("o_orderkey").alias("expid"), F.col("o_custkey").alias("peakid"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("season"),
        (flag == "F").cast("int").alias("claimed"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", 0).alias("disputed"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 0)
        .when(F.col("o_orderpriority") == "2-HIGH", 1).alias("nohired"),
        F.when(flag == "O", 0).when(flag == "P", 5).alias("tothired"),
        F.lit(0).alias("o2unkwn"), (F.col("o_totalprice") > 250000).cast("int").alias("comrte"),
        F.col("o_totalprice").alias("totmembers"))


def _expedition_view(t, orders):
    """Customers as peaks, and a season table that lacks some codes."""
    peaks = t("customer").select(F.col("c_custkey").alias("peak_id"),
                                 F.col("c_mktsegment").alias("himal"),
                                 F.col("c_acctbal").alias("height"))
    seasons = t("nation").where(F.col("n_regionkey") != 2).select(
        F.col("n_nationkey").alias("season"), F.col("n_name").alias("seasonname"))
    return warehouse.expeditions(orders, peaks, seasons)


def _expeditions(t):
    return _expedition_view(t, _expedition_rows(t))


def _member_rows(t):
    """Lineitems as members."""
    return t("lineitem").select(
        F.col("l_orderkey").alias("expid"), F.col("l_linenumber").alias("membid"),
        F.col("l_linestatus").alias("sex"), F.col("l_quantity").alias("calcage"),
        (F.col("l_returnflag") == "R").cast("int").alias("hired"),
        F.lit(0).alias("sherpa"), F.lit(0).alias("tibetan"), F.lit(0).alias("mclaimed"),
        F.when(F.col("l_discount") < 0.1, 0).alias("mdisputed"),
        F.when(F.col("l_tax") > 0.04, 1).alias("mo2used"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(2).alias("msmtterm"))


def _members(t):
    return warehouse.members(_member_rows(t))


_BASE_SQL = """
    SELECT o_orderkey AS expedition_id, l_linenumber AS member_id,
           CAST(year(o_orderdate) AS INT) AS expedition_year, n_name AS season,
           c_mktsegment AS himal, o_custkey AS peak_id, c_acctbal AS height,
           CASE WHEN o_totalprice > 250000 THEN 'Y' ELSE 'N' END AS commercial_route,
           o_totalprice AS total_members,
           CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 5 END AS total_hired,
           l_linestatus AS sex, l_quantity AS age,
           CASE WHEN l_tax > 0.04 THEN 'Y' ELSE 'N' END AS o2_used,
           CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS successful_summit
    FROM orders JOIN customer ON o_custkey = c_custkey
         LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON month(o_orderdate) = n_nationkey
         JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderstatus <> 'F' AND o_orderpriority <> '4-NOT SPECIFIED'
      AND NOT (CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 END = 0
               AND CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 5 END = 0)
      AND l_returnflag <> 'R' AND l_discount < 0.1 AND year(o_orderdate) >= 1998"""


@query("base_view", _BASE_SQL)
def base_view(t):
    return rows_since(warehouse.attempts(_expeditions(t), _members(t)), "expedition_year", 1998)


def laid_out_attempts(t, folder: str, buckets: int = 8):
    """The base view over facts in buckets of their key, the expeditions in a folder for each year."""
    facts = {}
    for name, rows, by in (("expedition", _expedition_rows(t), ["year"]), ("member", _member_rows(t), [])):
        layouts.write_layout(rows, f"{folder}/{name}", "expid", buckets, by)
        facts[name] = layouts.open_layout(rows.sparkSession, f"{folder}/{name}", f"laid_{name}_{uuid.uuid4().hex}")
    view = warehouse.attempts(_expedition_view(t, facts["expedition"]), warehouse.members(facts["member"]))
    return rows_since(view, "expedition_year", 1998)


@query("laid_out_view", _BASE_SQL)
def laid_out_view(t):
    return laid_out_attempts(t, scratch_folder(t("orders").sparkSession, "facts"))


@query("expedition_view", """
    SELECT o_orderkey AS expedition_id, o_custkey AS peak_id,
           CAST(year(o_orderdate) AS INT) AS expedition_year, n_name AS season,
           c_mktsegment AS himal, c_acctbal AS height,
           CASE WHEN o_totalprice > 250000 THEN 'Y' ELSE 'N' END AS commercial_route,
           o_totalprice AS total_members,
           CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 5 END AS total_hired
    FROM orders JOIN customer ON o_custkey = c_custkey
         LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON month(o_orderdate) = n_nationkey
    WHERE o_orderstatus <> 'F' AND o_orderpriority <> '4-NOT SPECIFIED'
      AND NOT (CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 END = 0
               AND CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 5 END = 0)""")
def expedition_view(t):
    return _expeditions(t)


@query("member_view", """
    SELECT l_orderkey AS expedition_id, l_linenumber AS member_id, l_linestatus AS sex,
           l_quantity AS age, CASE WHEN l_tax > 0.04 THEN 'Y' ELSE 'N' END AS o2_used,
           CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS successful_summit
    FROM lineitem WHERE l_returnflag <> 'R' AND l_discount < 0.1""")
def member_view(t):
    return _members(t)


@query("decode_codes", """
    SELECT c_custkey, c_nationkey, n_name AS c_nationkey_name, n_regionkey,
           r_name AS n_regionkey_name
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey
         LEFT JOIN region ON n_regionkey = r_regionkey""")
def decode_codes(t):
    nations = t("nation").where(F.col("n_regionkey") != 2)
    named = rel.decode(t("customer").select("c_custkey", "c_nationkey"),
                       {"c_nationkey": (nations, "n_nationkey", "n_name")})
    placed = rel.lookup(named, nations, {"c_nationkey": "n_nationkey"},
                        {"n_regionkey": "n_regionkey"})
    return rel.decode(placed, {"n_regionkey": (t("region"), "r_regionkey", "r_name")})


_KEYS = ["l_partkey", "l_suppkey"]
_RANKED = """(SELECT *, max(l_shipdate) OVER (PARTITION BY l_partkey, l_suppkey) AS latest
              FROM lineitem)"""


@query("dedup_keep_latest", f"""
    SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber,
           strftime(l_shipdate, '%Y-%m-%d') AS shipdate FROM {_RANKED} WHERE l_shipdate = latest""")
def dedup_keep_latest(t):
    kept = quality.keep_latest(
        t("lineitem").select(*_KEYS, "l_orderkey", "l_linenumber", "l_shipdate"),
        _KEYS, "l_shipdate")
    return kept.select(*_KEYS, "l_orderkey", "l_linenumber",
                       F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipdate"))


@query("dedup_rejects", f"""
    SELECT l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS shipdate,
           strftime(latest, '%Y-%m-%d') AS kept FROM {_RANKED} WHERE l_shipdate <> latest""")
def dedup_rejects(t):
    lost = quality.superseded(t("lineitem").select(*_KEYS, "l_shipdate"), _KEYS, "l_shipdate")
    return lost.select(*_KEYS, F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipdate"),
                       F.date_format("kept_value", "yyyy-MM-dd").alias("kept"))


@query("dedup_counts", f"""
    SELECT count(*) FILTER (l_shipdate = latest) AS kept, count(*) AS total FROM {_RANKED}""")
def dedup_counts(t):
    return quality.duplicate_counts(t("lineitem"), _KEYS, "l_shipdate")


@query("latest_per_key", """
    SELECT l_partkey, l_suppkey, strftime(max(l_shipdate), '%Y-%m-%d') AS latest
    FROM lineitem GROUP BY ALL""")
def latest_per_key(t):
    return quality.latest_per_key(t("lineitem"), _KEYS, "l_shipdate").select(
        F.col("_k_l_partkey").alias("l_partkey"), F.col("_k_l_suppkey").alias("l_suppkey"),
        F.date_format("_latest", "yyyy-MM-dd").alias("latest"))


@query("key_violations", """
    SELECT l_orderkey, l_linenumber, count(*) AS rows,
           CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null key'
                ELSE 'repeated key' END AS problem
    FROM lineitem GROUP BY 1, 2
    HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def key_violations(t):
    return quality.key_violations(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("last_wins", """
    SELECT user_id, event_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def last_wins(t):
    return quality.last_wins(
        t("events").select("user_id", "event_id", "event_type", "value", "props"),
        ["user_id"], "event_id")


@query("group_cardinality", """
    SELECT o_custkey, count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) <> 1""")
def group_cardinality(t):
    return quality.unexpected_counts(t("orders"), ["o_custkey"], 1)


@query("year_range", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def year_range(t):
    recent = t("orders").where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp"))
    return recent.select("o_orderkey", "o_custkey", "o_totalprice")


@query("ordered_head", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def ordered_head(t):
    ranked = t("orders").select("o_orderkey", "o_totalprice",
                                (-F.col("o_totalprice")).alias("_rank"))
    return rel.first_rows(ranked, ["_rank", "o_orderkey"], 25).drop("_rank")


@query("tag_filter", """
    SELECT event_id, user_id, value, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k
    FROM events
    WHERE json_extract_string(props, '$.k') IS NOT NULL
      AND regexp_matches(event_type, '(?i)CLI|pur') AND NOT regexp_matches(event_type, '(?i)chase')
      AND value BETWEEN 5 AND 60 AND user_id BETWEEN 3 AND 120""")
def tag_filter(t):
    elements = t("events").select(
        "*", F.map_concat(F.from_json("props", "MAP<STRING, STRING>"),
                          F.create_map(F.lit("kind"), F.col("event_type"))).alias("tags"))
    return (elements.where(el.has_tag("k") & el.tag_matches("kind", "CLI|pur")
                           & ~el.tag_matches("kind", "chase")
                           & el.in_window(5, 3, 60, 120, lon="user_id", lat="value"))
            .select("event_id", "user_id", "value", el.tag("k").alias("k")))


@query("null_filter", """
    SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)
    WHERE quality IS NOT NULL AND toxic IS NOT NULL""")
def null_filter(t):
    marked = rel.lookup(t("documents").select("doc_id"), t("labels"), {"doc_id": "doc_id"},
                        {"quality": "quality", "toxic": "toxic"})
    return marked.dropna(subset=["quality", "toxic"]).select("doc_id", "quality")


@query("column_subset", """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem""")
def column_subset(t):
    return rel.without_columns(t("lineitem"), {
        "l_partkey", "l_suppkey", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"})


@query("anti_leaf", """
    SELECT p_partkey, p_partkey // 10 AS parent FROM part
    WHERE p_partkey NOT IN (SELECT p_partkey // 10 FROM part)""")
def anti_leaf(t):
    tree = t("part").select("p_partkey", F.floor(F.col("p_partkey") / 10).alias("parent"))
    return rel.leaves(tree, "p_partkey", "parent")


@query("strict_lookup_orphans", """
    SELECT 'labels' AS source, doc_id AS id FROM labels
    WHERE doc_id NOT IN (SELECT doc_id FROM documents)
    UNION ALL SELECT 'conversations', conv_id FROM conversations
    WHERE conv_id NOT IN (SELECT doc_id FROM labels)""")
def strict_lookup_orphans(t):
    lost = rel.orphans(t("labels"), t("documents"), {"doc_id": "doc_id"}).select(
        F.lit("labels").alias("source"), F.col("doc_id").alias("id"))
    return lost.unionByName(
        rel.orphans(t("conversations"), t("labels"), {"conv_id": "doc_id"}).select(
            F.lit("conversations").alias("source"), F.col("conv_id").alias("id")))


@query("override_merge", """
    SELECT p_partkey AS id, CASE WHEN p_size > 45 THEN p_type ELSE p_brand END AS target
    FROM part""")
def override_merge(t):
    part = t("part").withColumn("id", F.col("p_partkey"))
    return rel.merge_overrides(
        part.select("id", F.col("p_brand").alias("target")),
        part.where(F.col("p_size") > 45).select("id", F.col("p_type").alias("target")), "id")


@query("alt_names", """
    SELECT p_partkey, nullif(array_to_string(list_sort(list_filter(list_distinct(
        list_concat(string_split(p_name, ' '), [p_type, lower(p_type)], string_split(p_name, ' '))),
        lambda x: x <> '' AND x <> split_part(p_name, ' ', 1))), ','), '') AS names
    FROM part""")
def alt_names(t):
    words = F.replace(F.col("p_name"), F.lit(" "), F.lit(" , ,"))
    return t("part").select("p_partkey", golden.alternative_names(
        F.split_part("p_name", F.lit(" "), F.lit(1)),
        [words, F.concat_ws(",", "p_type", F.lower("p_type")), words]).alias("names"))


@query("note_concat", """
    SELECT p_partkey, nullif(concat_ws(chr(10),
        CASE WHEN p_size > 20 THEN 'first: (' || p_type || ', ' || p_name || ')' END,
        CASE WHEN p_retailprice > 950 THEN 'second: (' || p_brand || ', ' || p_type || ')' END),
        '') AS notes
    FROM part""")
def note_concat(t):
    return t("part").select("p_partkey", golden.coordinate_notes([
        ("first", F.when(F.col("p_size") > 20, F.col("p_name")), F.col("p_type")),
        ("second", F.when(F.col("p_retailprice") > 950, F.col("p_type")), F.col("p_brand")),
    ]).alias("notes"))


@query("coalesce_sources", """
    SELECT p_partkey,
           CASE WHEN p_size > 30 THEN 'N' WHEN p_retailprice > 950 THEN 'Y' END AS approximate,
           CASE WHEN p_size > 30 THEN p_retailprice WHEN p_retailprice > 950 THEN p_size END AS lon,
           CASE WHEN p_size > 30 THEN p_name WHEN p_retailprice > 950 THEN p_type END AS dms
    FROM part""")
def coalesce_sources(t):
    chosen = first_source([
        (F.col("p_size") > 30, {"approximate": F.lit("N"), "lon": F.col("p_retailprice"),
                                "dms": F.col("p_name")}),
        (F.col("p_retailprice") > 950, {"approximate": F.lit("Y"),
                                        "lon": F.col("p_size").cast("double"),
                                        "dms": F.col("p_type")})])
    return t("part").select("p_partkey", chosen.alias("c")).select("p_partkey", "c.*")


@query("accuracy", """
    SELECT round(avg(CASE WHEN (n_chars > 1000) = (quality = 1) THEN 1.0 ELSE 0.0 END), 6)
           AS accuracy, count(*) AS rows
    FROM documents JOIN labels USING (doc_id)""")
def accuracy_of_rule(t):
    ruled = t("documents").join(t("labels"), "doc_id").select(
        (F.col("n_chars") > 1000).cast("int").alias("prediction"),
        F.col("quality").alias("label"))
    return accuracy(ruled).select(F.round("accuracy", 6).alias("accuracy"), "rows")
